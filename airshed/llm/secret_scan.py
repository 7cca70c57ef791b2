"""Secret scans: fixed patterns, and a randomness test battery for other tokens.
DataFrame expressions only.

Candidate tokens (20 or more characters of the base64 alphabets, with a letter and a
digit) get an inferred encoding and its tests: chi-squared against a uniform alphabet,
the number of runs of character classes, and the lag-1 serial correlation of the codes. A token is a
secret if none of the tests rejects randomness, and if it is a discovery against
natural text: the probability that natural text repeats as few characters and
changes class as often is combined by Fisher's rule, and the Benjamini-Hochberg
procedure controls the false discoveries in each class of encoding and length, over all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import table, texts, written

ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
#: kind -> (pattern, least characters of group 2). The patterns of access and hex hold their least
#: lengths themselves: a run too short cannot hold a match that is long enough.
KINDS = {
    "assign": (ASSIGN, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0),
    "hex": (r"[0-9a-f]{24,}", 0),
    "random": (r"[A-Za-z0-9+/=_-]{20,}", 0),
}
BASE = ("assign", "access", "hex")

#: Encodings in the order they are tried: name, pattern of the whole token (separators removed), alphabet.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER),
    ("base64", "^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
)
#: Upper ends of the length classes.
LENGTHS = (31, 47, 79)
#: Natural text: chance that two letters are equal, excess of the third moment, and rate of class changes.
NATURAL_EQUAL, NATURAL_THIRD, NATURAL_CHANGES = 0.0655, 0.001, 0.15
#: Randomness is rejected below this chance; share of false discoveries allowed; steps of the logarithm of p.
REJECT, FALSE_SHARE, BIN = 0.001, 0.01, 0.1


def _normal(z: Column) -> Column:
    """The normal distribution function, by its logistic approximation (monotone; within 0.0002)."""
    return 1 / (1 + F.exp(-F.greatest(F.least(1.5976 * z + 0.070566 * z * z * z, F.lit(60.0)), F.lit(-60.0))))


def matches(docs: DataFrame) -> DataFrame:
    """uid, doc_id, digest and, per kind, the matches with the gaps before them: one pass over the texts, written.

    A gap is the number of code points since the previous match; only the lengths of what lies between matches are kept.
    """
    d = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, (pattern, _) in KINDS.items():
        d = d.withColumn(f"m_{kind}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    found = []
    for kind, (pattern, least) in KINDS.items():
        some = F.size(f"m_{kind}") > 0
        gaps = F.transform(F.split("text", pattern, -1), lambda x: F.char_length(x))
        values = F.regexp_extract_all("text", F.lit(pattern), F.lit(2)) if least else F.col(f"m_{kind}")
        found.append(F.when(some, F.filter(F.arrays_zip(F.col(f"m_{kind}").alias("match"), gaps.alias("gap"), values.alias("value")),
                                           lambda x: x["match"].isNotNull())).alias(kind))
    return written(d.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), *found),
                   "secret-matches")


def _rows(found: DataFrame) -> DataFrame:
    """One row per match: uid, rank of its kind, start, end, value. Starts are
    running sums over a document's matches of a kind (lengths, not texts)."""
    parts = []
    for rank, (kind, (_, least)) in enumerate(KINDS.items()):
        rows = found.filter(F.col(kind).isNotNull()).select("uid", F.posexplode(kind).alias("nth", "x"))
        parts.append(rows.select("uid", F.lit(rank).alias("rank"), "nth", F.col("x.gap").alias("gap"),
                                 F.char_length("x.match").alias("length"), F.col("x.value").alias("value")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    so_far = Window.partitionBy("uid", "rank").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(so_far)
    rows = rows.select("uid", "rank", (end - F.col("length")).alias("start"), end.alias("end"), "value")
    for rank, (_, least) in enumerate(KINDS.values()):
        if least:
            rows = rows.filter((F.col("rank") != rank) | (F.char_length("value") >= least))
    return rows


#: Columns of a candidate token.
TOKEN = ("uid", "rank", "start", "end", "value")


def battery(tokens: DataFrame) -> DataFrame:
    """Add the encoding, length class, the three chances under randomness and ``p``, the
    combined chance under natural text, to rows of ``TOKEN``. Tokens without a letter or without a digit are left out."""
    core = F.regexp_replace("value", "[+/=_-]", "")
    t = tokens.withColumn("core", core).withColumn("n", F.char_length("core").cast("double")).filter(
        (F.col("n") >= 16) & F.col("core").rlike("[0-9]") & F.col("core").rlike("[A-Za-z]"))
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern, letters in reversed(ENCODINGS):
        encoding = F.when(F.col("core").rlike(pattern), name).otherwise(encoding)
        alphabet = F.when(F.col("core").rlike(pattern), letters).otherwise(alphabet)
    t = _settled(t, n="n", core="core", encoding=encoding, alphabet=alphabet)
    one_case = F.when(F.col("encoding").isin("hex", "base36"), F.lower("core")).otherwise(F.col("core"))
    t = _settled(t, n="n", encoding="encoding", alphabet="alphabet", k=F.length("alphabet").cast("double"), core=one_case, chars=F.split(one_case, "(?!^)"))
    classes = F.translate("core", DIGITS + LOWER + UPPER, "0" * 10 + "a" * 26 + "A" * 26)
    t = _settled(
        t, n="n", k="k", encoding="encoding",
        codes=F.expr("transform(chars, c -> cast(position(c, alphabet) as double))"),
        squares=F.expr("aggregate(array_distinct(chars), 0D, (a, c) -> a + power(n - length(replace(core, c, '')), 2))"),
        changes=(F.size(F.regexp_extract_all(classes, F.lit(r"(.)\1*"), F.lit(0))) - 1).cast("double"))
    t = _settled(t, n="n", k="k", encoding="encoding", codes="codes", squares="squares", changes="changes",
                 mean=F.expr("aggregate(codes, 0D, (a, x) -> a + x) / n"))
    t = _settled(
        t, n="n", k="k", encoding="encoding", squares="squares", changes="changes",
        var=F.expr("aggregate(codes, 0D, (a, x) -> a + (x - mean) * (x - mean))"),
        cov=F.expr("aggregate(zip_with(codes, slice(codes, 2, int(n) - 1), (x, y) -> (x - mean) * (coalesce(y, mean) - mean)), 0D, (a, x) -> a + x)"))
    # chi-squared against the uniform alphabet, made normal by its cube root
    df = F.col("k") - 1
    chi = F.col("k") / F.col("n") * F.col("squares") - F.col("n")
    cube = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    # runs of classes: upper, lower, digit; their expected changes under the uniform alphabet
    rate = F.when(F.col("encoding") == "hex", 2 * 10 * 6 / 256).when(F.col("encoding") == "base32", 2 * 26 * 6 / 1024).when(
        F.col("encoding") == "base36", 2 * 10 * 26 / 1296).otherwise(1 - (2 * 26 ** 2 + 10 ** 2) / 62 ** 2)
    def z_changes(r: Column) -> Column:
        return (F.col("changes") - (F.col("n") - 1) * r) / F.sqrt((F.col("n") - 1) * r * (1 - r))
    # serial correlation of neighbouring codes
    serial = F.when(F.col("var") > 0, F.col("cov") / F.col("var")).otherwise(1.0) * F.sqrt("n")
    # natural text: equal pairs (fewer in a random token) and class changes (more), by Fisher's rule
    pairs, equal = F.col("n") * (F.col("n") - 1) / 2, (F.col("squares") - F.col("n")) / 2
    spread = F.sqrt(pairs * NATURAL_EQUAL * (1 - NATURAL_EQUAL) + F.col("n") * (F.col("n") - 1) * (F.col("n") - 2) * NATURAL_THIRD)
    x = -F.log(_normal((equal + 0.5 - pairs * NATURAL_EQUAL) / spread)) - F.log(_normal(-z_changes(F.lit(NATURAL_CHANGES))))
    length = F.lit(0)
    for i, end in enumerate(LENGTHS):
        length = F.when(F.col("n") > end, i + 1).otherwise(length)
    return _settled(t, encoding="encoding", length_class=length, p_uniform=1 - _normal(cube), p_runs=2 * _normal(-F.abs(z_changes(rate))),
                    p_serial=2 * _normal(-F.abs(serial)), p=F.exp(-x) * (1 + x)).select(
        *tokens.columns, "encoding", "length_class", "p_uniform", "p_runs", "p_serial", "p")


def _settled(t: DataFrame, **columns: Column | str) -> DataFrame:
    """The token's own columns (uid to value) and the given ones, computed once: they come out of a one-row generator, so
    that later lambdas and filters refer to values and not to copies of the expressions."""
    made = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
    return t.select(*TOKEN, F.inline(F.array(made)))


def discoveries(tested: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """The rows of ``battery`` that are secrets. Benjamini-Hochberg per encoding and
    length class: chances are counted in steps of a tenth of their logarithm, a bounded table; the
    largest step whose chance is at most ``share`` times its cumulative part of all tokens is the limit."""
    step = F.floor(-F.log10(F.greatest("p", F.lit(1e-30))) / BIN).cast("int")
    t = tested.withColumn("step", step)
    stratum = ["encoding", "length_class"]
    counts = t.groupBy(*stratum, "step").agg(F.count("*").alias("n"))
    below = Window.partitionBy(*stratum).orderBy(F.desc("step"))
    limits = (counts.withColumn("reached", F.sum("n").over(below)).withColumn("all", F.sum("n").over(Window.partitionBy(*stratum)))
              .filter(F.pow(F.lit(10.0), -BIN * F.col("step")) <= share * F.col("reached") / F.col("all"))
              .groupBy(*stratum).agg(F.min("step").alias("limit")))  # at most one row per encoding and length class
    random = (F.col("p_uniform") >= REJECT) & (F.col("p_runs") >= REJECT) & (F.col("p_serial") >= REJECT)
    return t.join(F.broadcast(limits), stratum).filter((F.col("step") >= F.col("limit")) & random)


def find_spans(found: DataFrame) -> DataFrame:
    """uid, rank, start, end of every secret in ``matches``: all base matches, and tested tokens
    that lie in no base span of their document."""
    rows = _rows(found)
    random = list(KINDS).index("random")
    rows = written(rows, "secret-rows")
    base = rows.filter(F.col("rank") != random).select("uid", "rank", "start", "end")
    added = discoveries(battery(rows.filter(F.col("rank") == random))).select("uid", "rank", "start", "end")
    before = Window.partitionBy("uid").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("rank") != random, F.col("end"))).over(before)
    return (base.unionByName(added).withColumn("covered", covered)
            .filter((F.col("rank") != random) | F.col("covered").isNull() | (F.col("covered") < F.col("end"))).drop("covered"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, digest and ``spans`` (sorted array of start, rank of the kind, end) of every row of ``docs``.

    A null text is empty; null doc_ids and repeated rows are rows like any other; no document, no row.
    """
    found = matches(docs)
    spans = find_spans(found).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end"))).alias("spans"))
    return found.select("uid", "doc_id", "digest").join(spans, "uid", "left").drop("uid").withColumn(
        "spans", F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, rank: int, end: bigint>>)")))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (doc_id, text and any further columns, all kept) with every span of the text
    replaced by ``mark``; overlapping spans become one. Other texts, null ones too, stay as they are."""
    columns = docs.columns
    found = scan(docs).filter(F.size("spans") > 0).groupBy("doc_id", "digest").agg(F.first("spans").alias("spans"))
    # merge: a span joins the last one if it begins before that one's end
    merged = F.expr("""aggregate(spans, cast(array() as array<struct<start: bigint, end: bigint>>), (a, s) ->
        if(size(a) > 0 and s.start < element_at(a, -1).end,
           concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, s.end) as end))),
           concat(a, array(struct(s.start as start, s.end as end)))))""")
    found = found.select("doc_id", "digest", merged.alias("spans"))
    d = docs.select(F.struct("*").alias("row"), docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("body"))
    d = d.withColumn("digest", F.sha2(F.coalesce("body", F.lit("")).cast("binary"), 256))
    joined = d.join(found, d["id"].eqNullSafe(found["doc_id"]) & (d["digest"] == found["digest"]), "left").select("row", "body", "spans")
    pieces = F.expr(f"""concat_ws('', transform(spans, (s, i) -> concat(substring(body, int(if(i = 0, 0, spans[i - 1].end)) + 1,
        int(s.start - if(i = 0, 0, spans[i - 1].end))), '{mark}')), substring(body, int(element_at(spans, -1).end) + 1))""")
    out = joined.select("row", F.when(F.col("spans").isNull(), F.col("body")).otherwise(pieces).alias("body"))
    return out.select(*[F.col("body").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns])


def op10_randomness_battery(spark, sf_dir: str) -> DataFrame:
    spans = scan(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, KINDS))
    def joined(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == list(KINDS).index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return spans.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
