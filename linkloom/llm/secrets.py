"""Secret scan: three fixed forms, and tokens that pass for random.

Only DataFrame functions.  One pass over the texts keeps what the patterns hit and the distances
between hits, never the texts; positions are running sums of those.

The fixed forms are ``assign``, ``access`` and ``hex``.  Beside them every run of at least
``MIN_RUN`` letters, digits and ``+/_-``, with the ``=`` after it, is tested as ``random``; where no
alphabet holds a run, as when a token is glued to a path, its longest parts that one holds are:

* its encoding is the smallest alphabet that holds all its characters: hexadecimal, base 32, base
  36, base 64 (without padding).  Runs without a digit or without a letter have none;
* a battery asks whether it could be drawn from that alphabet: chi-squared of the symbols' counts,
  a runs test of upper against lower half of the alphabet, lag-one serial correlation, and the
  shares of digits and of capitals.  Each gives a standard score; the largest decides;
* what is left must stand out from ordinary tokens (words, dates, names with numbers), which stay
  within a class of characters for long.  The ratio of both likelihoods is an e-value that grows
  with length; the e-BH rule over all tested tokens of the corpus keeps the expected share of
  ordinary tokens among those reported below ``FALSE_SHARE``.

A reported token that overlaps no fixed form becomes a span of kind ``random``.  Of overlapping
parts of a run that with the most evidence goes first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.llm.common import table
from linkloom.session import stored

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, group and least length of what the group holds.
FORMS = (("assign", ASSIGN, 1, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))
MIN_RUN = 20
RANDOM = "random"
#: Characters of a run, and those of the alphabets that hold the others.
RUN, WIDEST = r"[A-Za-z0-9+/_-]", ("[A-Za-z0-9+/]", "[A-Za-z0-9_-]")
#: Largest standard score that a random token may show in any test.
MAX_SCORE = 3.7
FALSE_SHARE = 0.01

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encoding, pattern of its tokens, its alphabet; the first that fits holds.
ENCODINGS = (
    ("hex", "[0-9a-f]+", _DIGITS + "abcdef"),
    ("HEX", "[0-9A-F]+", _DIGITS + "ABCDEF"),
    ("base32", "[A-Z2-7]+", _UPPER + "234567"),
    ("base36", "[a-z0-9]+", _DIGITS + _LOWER),
    ("BASE36", "[A-Z0-9]+", _DIGITS + _UPPER),
    ("base64", "[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: An ordinary token stays in its class of characters with this probability.
STAY = 0.9
_BINS = 4  # a unit of log evidence


def _scan(text: Column, pattern: str, whole: str, group: int) -> Column:
    """[(gap, hit, value)] of all leftmost matches; ``gap`` is the distance from the match before.

    ``pattern`` tells cheaply whether there is anything to look for.
    """
    gaps = F.transform(F.split(text, whole, -1), lambda x: F.length(x))
    hits = F.regexp_extract_all(text, F.lit(whole if group else f"({whole})"), F.lit(0 if group else 1))
    values = F.regexp_extract_all(text, F.lit(whole if group else f"({whole})"), F.lit(1))
    zipped = F.zip_with(hits, values, lambda h, v: F.struct(F.length(h).alias("length"), v.alias("value")))
    out = F.zip_with(F.slice(gaps, 1, F.size(hits)), zipped, lambda g, z: F.struct(g.alias("gap"), z["length"].alias("length"), z["value"].alias("value")))
    return F.when(text.rlike(pattern), out)


def _long(characters: str) -> str:
    """Pattern of a maximal run that is long enough, and its padding."""
    return f"{characters}{{{MIN_RUN},}}=*"


def _hits(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, kind, place, gap, length, value), a row without kind for texts without hits."""
    text, found = F.col("text"), []
    for kind, pattern, group, least in FORMS:
        # runs are maximal, so asking for the least length finds the same ones; an assignment that is
        # too short still uses up its text
        whole = pattern if group else pattern.replace("+", f"{{{least - 4 if kind == 'access' else least},}}")
        found.append(F.struct(F.lit(kind).alias("kind"), _scan(text, whole, whole, group).alias("hits")))
    run = _long(RUN)
    found.append(F.struct(F.lit(RANDOM).alias("kind"), _scan(text, run, run, 0).alias("hits")))
    scanned = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.array(*found).alias("_found"))
    kept = F.filter("_found", lambda x: F.size(F.coalesce(x["hits"], F.array())) > 0)
    return stored(scanned.select("_row", "doc_id", kept.alias("found")))


def _placed(hits: DataFrame, *keys: str) -> DataFrame:
    """(_row, *keys, kind, start, end, value) of every hit; code points, end exclusive."""
    kinds = hits.select("_row", *keys, F.explode("found").alias("f")).select("_row", *keys, "f.kind", F.posexplode("f.hits").alias("place", "h"))
    before = Window.partitionBy("_row", *keys, "kind").orderBy("place")
    end = F.sum(F.col("h.gap").cast("long") + F.col("h.length")).over(before)
    return kinds.select("_row", *keys, "kind", (end - F.col("h.length")).alias("start"), end.alias("end"), F.col("h.value").alias("value"))


def _tokens(runs: DataFrame) -> DataFrame:
    """(_row, _run, start, end, value): runs that some alphabet holds, and the longest such parts of others.

    ``_run`` is the start of the run.
    """
    fits = F.col("value").rlike("^(" + "|".join(f"{x}+" for x in WIDEST) + ")=*$")
    names = ["_row", "_run", "start", "end", "value"]
    runs = runs.select("_row", F.col("start").alias("_run"), "start", "end", "value", fits.alias("_fits"))
    found = [F.struct(F.lit(x).alias("kind"), _scan(F.col("value"), _long(x), _long(x), 0).alias("hits")) for x in WIDEST]
    parts = _placed(runs.filter("not _fits").select("_row", "_run", F.array(*found).alias("found")), "_run")
    parts = parts.withColumns({"start": F.col("_run") + F.col("start"), "end": F.col("_run") + F.col("end")}).select(names)
    return runs.filter("_fits").select(names).unionByName(parts.dropDuplicates(["_row", "start", "end"]))


def _apart(tokens: DataFrame) -> DataFrame:
    """(_row, start, end) of tokens, without those that overlap one of the same run with more evidence."""
    runs = tokens.groupBy("_row", "_run").agg(F.array_sort(F.collect_list(F.struct((-F.col("evidence")).alias("order"), "start", "end"))).alias("_all"))
    none = F.slice("_all", 1, 0)
    kept = F.aggregate(
        "_all", none, lambda a, x: F.when(F.exists(a, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])), a).otherwise(F.concat(a, F.array(x)))
    )
    return runs.select("_row", F.explode(kept).alias("x")).select("_row", "x.start", "x.end")


# -- the battery ------------------------------------------------------------------------------------


def _score(observed: Column, mean: Column, variance: Column) -> Column:
    """Distance from the mean in standard deviations; endless where nothing could vary."""
    return F.when(variance > 0, F.abs(observed - mean) / F.sqrt(variance)).otherwise(F.lit(math.inf))


def _encoding(token: Column) -> Column:
    """struct(name, alphabet) of the smallest alphabet; null without a digit or a letter."""
    out = F.lit(None)
    for name, pattern, alphabet in reversed(ENCODINGS):
        out = F.when(token.rlike(f"^{pattern}$"), F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"))).otherwise(out)
    return F.when(token.rlike("[0-9]") & token.rlike("[A-Za-z]"), out)


def battery(tokens: DataFrame, token: str = "value") -> DataFrame:
    """``tokens`` with encoding, size, worst (the largest score of the battery) and evidence.

    ``evidence`` is the log likelihood of the encoding's uniform draw over that of an ordinary
    token.  Tokens without an encoding, or shorter than ``MIN_RUN`` without their padding, have
    nulls.
    """
    bare = F.regexp_replace(token, "=+$", "")
    df = tokens.withColumn("_bare", bare).withColumn("_enc", F.when(F.length(bare) >= MIN_RUN, _encoding(F.col("_bare"))))
    df = df.withColumn("_chars", F.when(F.col("_enc").isNotNull(), F.split("_bare", "")))
    df = df.withColumn("_codes", F.transform("_chars", lambda c: F.instr(F.col("_enc.alphabet"), c) - 1))
    n, k = F.size("_chars").cast("double"), F.length("_enc.alphabet").cast("double")

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def share(low: str, high: str) -> Column:
        return F.size(F.filter("_chars", lambda c: c.between(low, high))).cast("double")

    squares = total(F.transform(F.array_distinct("_chars"), lambda c: F.pow(F.size(F.filter("_chars", lambda x: x == c)).cast("double"), F.lit(2.0))))
    symbols = _score(squares * k / n - n, k - 1, 2 * (k - 1) * (n - 1) / n)

    high = F.transform("_codes", lambda x: (x >= k / 2).cast("int"))
    above = total(F.transform(high, lambda x: x.cast("double")))
    product = 2 * above * (n - above)
    turns = total(F.zip_with(F.slice(high, 2, F.size(high)), F.slice(high, 1, F.size(high) - 1), lambda a, b: (a != b).cast("double")))
    runs = _score(turns + 1, product / n + 1, product * (product - n) / (n * n * (n - 1)))

    mean = total(F.transform("_codes", lambda x: x.cast("double"))) / n
    off = F.transform("_codes", lambda x: x - mean)
    spread = total(F.transform(off, lambda x: x * x))
    follow = total(F.zip_with(F.slice(off, 2, F.size(off)), F.slice(off, 1, F.size(off) - 1), lambda a, b: a * b))
    serial = F.when(spread > 0, F.abs(follow / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(math.inf))

    digits, capitals, smalls = share("0", "9"), share("A", "Z"), share("a", "z")
    odds = F.length(F.regexp_replace("_enc.alphabet", "[^0-9]", "")) / k
    of_digits = _score(digits, n * odds, n * odds * (1 - odds))
    letters = capitals + smalls
    of_capitals = F.when(F.col("_enc.name").startswith("base64"), _score(capitals, letters / 2, letters / 4)).otherwise(F.lit(0.0))

    kind = F.transform(
        "_chars", lambda c: F.when(c.between("a", "z"), 26.0).when(c.between("A", "Z"), 26.5).when(c.between("0", "9"), 10.0).otherwise(4.0)
    )
    stays = total(F.zip_with(F.slice(kind, 2, F.size(kind)), F.slice(kind, 1, F.size(kind) - 1), lambda a, b: (a == b).cast("double")))
    inside = total(F.transform(kind, lambda x: F.log(F.floor(x))))
    ordinary = stays * math.log(STAY) + (n - 1 - stays) * math.log((1 - STAY) / 3) - inside
    worst = F.greatest(symbols, runs, serial, of_digits, of_capitals)
    tested = F.col("_enc").isNotNull()
    df = df.withColumns(
        {
            "encoding": F.col("_enc.name"),
            "size": F.when(tested, n.cast("long")),
            "worst": F.when(tested, worst),
            "evidence": F.when(tested, -n * F.log(k) - ordinary),
        }
    )
    return df.drop("_bare", "_enc", "_chars", "_codes")


def evidence_needed(tested: DataFrame, false_share: float = FALSE_SHARE) -> float:
    """The e-BH bound over all tested tokens: the least evidence t with t >= log(m / (share * kept)).

    Found on a histogram, at most a few thousand rows whatever the corpus; endless if none is met.
    """
    top = 1000 * _BINS
    bins = tested.filter("evidence is not null").select(
        F.least(F.greatest(F.floor(F.col("evidence") * _BINS), F.lit(0)), F.lit(top)).alias("bin"), (F.col("worst") <= MAX_SCORE).cast("int").alias("ok")
    )
    counts = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("ok").alias("ok"))
    down = Window.partitionBy().orderBy(F.col("bin").desc())
    kept, everything = F.sum("ok").over(down), F.sum("n").over(Window.partitionBy())
    met = counts.select("bin", (F.log(everything / false_share) - F.log(kept)).alias("needed")).filter(F.col("bin") / _BINS >= F.col("needed"))
    least = met.agg(F.min("bin")).first()[0]
    return math.inf if least is None else least / _BINS


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each row of ``docs`` (doc_id, text): [(start, end, kind)] in order.

    Null and empty texts have none.  Rows that repeat a doc_id are told apart.
    """
    hits = _hits(docs)
    placed = _placed(hits)
    assign = {kind: least for kind, _, group, least in FORMS if group}
    fixed = placed.filter(F.col("kind") != RANDOM)
    for kind, least in assign.items():
        fixed = fixed.filter((F.col("kind") != kind) | (F.length("value") >= least))
    tested = stored(battery(_tokens(placed.filter(F.col("kind") == RANDOM))).filter("evidence is not null"))
    random = tested.filter((F.col("worst") <= MAX_SCORE) & (F.col("evidence") >= evidence_needed(tested)))
    random = _apart(random).withColumn("kind", F.lit(RANDOM))
    order = F.array_position(F.array(*[F.lit(k) for k, *_ in FORMS], F.lit(RANDOM)), F.col("kind"))
    spans = fixed.drop("value").unionByName(random.select(*fixed.drop("value").columns))
    spans = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", order.alias("order"), "end", "kind"))).alias("_all"))
    base = F.filter("_all", lambda x: x["kind"] != RANDOM)
    free = F.filter("_all", lambda x: (x["kind"] != RANDOM) | ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    spans = spans.select(F.col("_row").alias("_r"), F.transform(free, lambda x: F.struct(x["start"], x["end"], x["kind"])).alias("spans"))
    rows = hits.join(spans, hits["_row"] == spans["_r"], "left")
    return rows.select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["kind"] != RANDOM)
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
