"""Reports over the Gold table and run-history monitoring.

Each report is ``(gold: DataFrame, as_of=..., limits=...) -> DataFrame``:
pure, lazy, built-in expressions only. ``as_of`` is the reporting date (a
date literal is pushed to the Gold scan; a Column such as the scalar subquery
``max(date)`` is accepted too; ``None`` means today).
"""
