"""Quality rules with a bitmask ledger, in DataFrame expressions only.

Every rule is evaluated once for each document. The ledger keeps the measurements
and one bit for each failed rule; policies are named sets of rules, applied to the
ledger as bit masks without another look at the texts; ablations are counts over masked bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import table, written

BLANK, BLANKS = r"[\x20\x09-\x0D]", " \t\n\x0b\f\r"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
#: Fixed value: scripts written without blanks between words (Thai, Lao, Myanmar, Khmer, kana, Han) with their full-width punctuation.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3000}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{20000}-\x{3FFFF}"
SPACED_WORD = rf"[^\x20\x09-\x0D{UNSPACED}]+"
LETTERS = r"[\p{L}\p{M}]+"
BULLET_LINE = r"^[\x20\x09-\x0D]*[-*\x{2022}\x{2023}\x{25AA}\x{25CF}]"

#: name -> (bit, failing condition over the measurements). A bit keeps its meaning for ever; changed rules get new bits.
RULES = {
    "few_words": (0, "n_words < 10"),
    "repeated_words": (1, "100 * n_repeat_words > 20 * n_words"),
    "symbols": (2, "100 * n_symbols > 40 * n_words"),
    "duplicate_lines": (3, "100 * n_dup_lines > 30 * n_lines"),
    "short_words": (4, "word_chars < 2 * n_words"),
    "long_words": (5, "word_chars > 25 * n_words"),
    "long_spaced_words": (6, "spaced_chars > 25 * n_spaced_words"),
    "few_letters": (7, "100 * n_letters < 40 * word_chars"),
    "ellipsis_lines": (8, "100 * n_ellipsis_lines > 30 * n_lines"),
    "bullet_lines": (9, "100 * n_bullet_lines > 90 * n_lines"),
    "frequent_pair": (10, "200 * n_top_pair > 20 * n_words and n_top_pair > 4"),
}
#: Versioned sets of rules; a document is kept if it fails none of them.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "corpus-1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words"),
    # long words are told by what lies between blanks and characters of scripts that have none
    "corpus-2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_spaced_words", "few_letters",
                 "ellipsis_lines", "bullet_lines", "frequent_pair"),
}
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
                "spaced_chars", "n_spaced_words", "n_letters", "n_ellipsis_lines", "n_bullet_lines", "n_top_pair")


def policy_mask(policy: str) -> int:
    return sum(1 << RULES[r][0] for r in POLICIES[policy])


def _hashed(docs: DataFrame) -> DataFrame:
    """Add hash1, hash2 and hash4: 64-bit hashes of the words and of the runs of two and of four neighbouring words, by where they start.
    Each step is a column of its own, since a lambda evaluates what it refers to anew for each element."""
    def joined(left: str, right: str, ahead: int, words: int) -> Column:
        """Of the hashes in ``left`` and those that start ``ahead`` words later in ``right``, where runs of ``words`` begin."""
        n = F.greatest(F.col("n_words") - (words - 1), F.lit(0)).cast("int")
        return F.zip_with(F.slice(left, 1, n), F.slice(right, 1 + ahead, n), lambda a, b: F.xxhash64(a, b))
    return (docs.withColumn("hash1", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("hash2", joined("hash1", "hash1", 1, 2)).withColumn("hash4", joined("hash2", "hash2", 2, 4))
            # a window is known by four words and the fifth; only a text in which four words recur has such a window twice
            .withColumn("windows", F.when(F.size(F.array_distinct("hash4")) < F.size("hash4"), joined("hash4", "hash1", WINDOW - 1, WINDOW))))


def _repeated(docs: DataFrame) -> DataFrame:
    """Add n_repeat_words: words in windows of five that occur twice or more in the text.

    In texts with such windows (few), numbers of the upper half of a window's hash and its position
    are sorted; neighbours that agree in the upper half are compared by whole hashes. The positions of
    equal ones, sorted, count the words they cover once.
    """
    low = F.lit((1 << 32) - 1)
    packed = F.when(F.size(F.array_distinct("windows")) < F.size("windows"),
                    F.sort_array(F.transform("windows", lambda h, i: F.shiftleft(F.shiftright(h, 32), 32).bitwiseOR(i.cast("long")))))
    def same(values: str, value: Column, at: Column, by) -> Column:
        return F.coalesce(by(F.get(F.col(values), at)) == by(value), F.lit(False))
    def neighbours(values: str, by) -> Column:
        return F.filter(values, lambda p, j: same(values, p, j - 1, by) | same(values, p, j + 1, by))
    def placed(p: Column) -> Column:
        i = p.bitwiseAND(low).cast("int")
        return F.struct(F.get(F.col("windows"), i).alias("h"), i.alias("i"))
    covered = F.aggregate(F.sort_array(F.transform("twice", lambda p: p["i"])),
                          F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
                          lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")))
    return (docs.withColumn("packed", packed).withColumn("alike", neighbours("packed", lambda p: F.shiftright(p, 32)))
            .withColumn("pairs", F.sort_array(F.transform("alike", placed))).withColumn("twice", neighbours("pairs", lambda p: p["h"]))
            .withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0).cast("long"))).drop("packed", "alike", "pairs", "twice", "windows"))


def _top_pair(docs: DataFrame) -> DataFrame:
    """Add n_top_pair: how often the most frequent pair of neighbouring words occurs. Hashes of the pairs are sorted; of a run of equals all
    but the first remain, and the longest run of these counts."""
    def step(acc: Column, h: Column) -> Column:
        run = F.when(acc["h"] == h, acc["run"] + 1).otherwise(F.lit(2).cast("long"))
        return F.struct(h.alias("h"), run.alias("run"), F.greatest(acc["top"], run).alias("top"))
    start = F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).cast("long").alias("run"), F.least(F.size("hash2"), F.lit(1)).cast("long").alias("top"))
    return (docs.withColumn("pairs", F.sort_array("hash2")).withColumn("again", F.filter("pairs", lambda h, j: h == F.get(F.col("pairs"), j - 1)))
            .withColumn("n_top_pair", F.aggregate("again", start, step)["top"]).drop("pairs", "again"))


def measure(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and the measurements of every row of ``docs`` (doc_id, text), in one pass without a shuffle.
    With ``carry``, the row itself too, as the struct ``row``, whatever its columns are called.

    A null text has no words; a null doc_id and repeated rows are measured like any other.
    Counts are in code points; a line counts if it holds a word, and is a duplicate if an equal line precedes it.
    Spaced words are what lies between blanks and characters of scripts written without blanks; marks count as letters.
    """
    row = [F.struct("*").alias("row")] if carry else []
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), *row)
    row = ["row"] if carry else []
    d = d.withColumn("words", F.array_remove(F.split("text", BLANK), ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # without such a character the spaced words are the words; all of them have three bytes or more in UTF-8, of which one range of code points tells
    unspaced = (F.octet_length("text") > F.char_length("text")) & F.col("text").rlike(r"[\x{0800}-\x{10FFFF}]") & F.col("text").rlike(f"[{UNSPACED}]")
    d = d.withColumn("spaced", F.when(unspaced, F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))))
    d = d.withColumn("joined", F.array_join("words", ""))
    # no symbol is a letter, a mark or a blank
    d = d.withColumn("others", F.regexp_replace("joined", F.lit(LETTERS), F.lit("")))
    def ellipsis(line: Column) -> Column:
        end = F.rtrim(line, F.lit(BLANKS))
        return end.endswith("...") | end.endswith("\u2026")
    d = d.select(
        "doc_id", *row, "words", F.size("words").cast("long").alias("n_words"),
        F.char_length("joined").cast("long").alias("word_chars"),
        F.regexp_count("others", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.char_length(F.array_join("spaced", "")), F.char_length("joined")).cast("long").alias("spaced_chars"),
        F.coalesce(F.array_size("spaced"), F.size("words")).cast("long").alias("n_spaced_words"),
        (F.char_length("joined") - F.char_length("others")).cast("long").alias("n_letters"),
        F.size(F.filter("lines", ellipsis)).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(BULLET_LINE))).cast("long").alias("n_bullet_lines"))
    # a generator of one row: filters on the measurements stay above it and do not copy the lambdas into each other
    return _top_pair(_repeated(_hashed(d))).select("doc_id", *row, F.inline(F.array(F.struct(*MEASUREMENTS))))


def ledger(docs: DataFrame, carry: bool = False) -> DataFrame:
    """The measurements with ``fail_bits``, one bit for each failed rule."""
    bits = " | ".join(f"if({condition}, {1 << bit}L, 0L)" for bit, condition in RULES.values())
    return measure(docs, carry).withColumn("fail_bits", F.expr(bits))


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """Add ``kept``: no rule of the policy failed. Reads the ledger only."""
    return entries.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0)


def kept_documents(docs: DataFrame, policy: str) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any further columns, of any names) that the policy keeps, as they are.

    Null and empty texts have no words and fail few_words; repeated rows stay or go together; an empty table stays empty.
    """
    return apply_policy(ledger(docs, carry=True), policy).filter("kept").select("row.*")


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail it alone
    (and would be kept without it), and that the policy rejects. One aggregation
    by the masked bits (at most 2 to the number of rules), expanded by rule afterwards."""
    mask = F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policy)).cast("long"))
    counts = entries.groupBy(mask.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("long").alias("bit")) for r in POLICIES[policy]])
    each = counts.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0)("fails"), count(F.col("bits") == F.col("bit"))("fails_alone"),
        count(F.col("bits") != 0)("rejected"))


def op9_rule_ledger(spark, sf_dir: str) -> DataFrame:
    """The ledger of all documents, written and read back, under the corpus policy."""
    entries = apply_policy(written(ledger(table(spark, sf_dir, "documents")), "quality-ledger"), "corpus-2")
    base = F.col("fail_bits").bitwiseAND(F.lit(policy_mask("base-1")).cast("long")) != 0
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          base.alias("base_failed"), "kept", *MEASUREMENTS[5:], "fail_bits")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (regexp_matches(line, '(\x{2026}|\.\.\.)[\x20\x09-\x0D]*$')) AS n_ellipsis_lines,
    count(*) FILTER (regexp_matches(line, '^[\x20\x09-\x0D]*[-*\x{2022}\x{2023}\x{25AA}\x{25CF}]')) AS n_bullet_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
word_rows AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
starts AS (SELECT doc_id, i, word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w
    || ' ' || lead(word, 4) OVER w AS five FROM word_rows WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM starts WHERE five IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_repeat_words FROM
  (SELECT doc_id, unnest(range(i, i + 5)) AS w FROM windows WHERE n > 1) GROUP BY doc_id),
pair_counts AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM word_rows)
  WHERE after IS NOT NULL GROUP BY doc_id, word, after),
top_pairs AS (SELECT doc_id, max(n) AS n_top_pair FROM pair_counts GROUP BY doc_id),
spaced AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D@UNSPACED@]+') AS spaced FROM d),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(array_to_string(spaced, '')) AS spaced_chars, len(spaced) AS n_spaced_words, len(regexp_extract_all(text, '[\p{L}\p{M}]')) AS n_letters,
    coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines, coalesce(n_bullet_lines, 0) AS n_bullet_lines, coalesce(n_top_pair, 0) AS n_top_pair
  FROM d JOIN spaced USING (doc_id) LEFT JOIN line_counts USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN top_pairs USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 40 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN spaced_chars > 25 * n_spaced_words THEN 64 ELSE 0 END) + (CASE WHEN 100 * n_letters < 40 * word_chars THEN 128 ELSE 0 END)
    + (CASE WHEN 100 * n_ellipsis_lines > 30 * n_lines THEN 256 ELSE 0 END) + (CASE WHEN 100 * n_bullet_lines > 90 * n_lines THEN 512 ELSE 0 END)
    + (CASE WHEN 200 * n_top_pair > 20 * n_words AND n_top_pair > 4 THEN 1024 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits % 4 > 0 AS base_failed,
  fail_bits & ~32 = 0 AS kept, n_lines, spaced_chars, n_spaced_words, n_letters, n_ellipsis_lines, n_bullet_lines, n_top_pair,
  CAST(fail_bits AS BIGINT) AS fail_bits FROM b
""".replace("@UNSPACED@", UNSPACED)
