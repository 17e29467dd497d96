"""Secret scans: known forms and a battery of randomness tests.

Known forms are three patterns (``assign``, ``access``, ``hex``). The battery
adds ``random`` spans: maximal runs of ``[A-Za-z0-9+/_=-]``, known spans cut out of
them. A run that fits no encoding (``NAME=value``, paths, a prefix before
base64) is split at inner ``=``, and what still fits none both at ``/`` and
``+`` and at ``-`` and ``_``. Pieces of at least ``MIN_RUN`` characters are
tested. From the characters that occur an encoding is inferred (hex, letters of
one or both cases, base32, base36, base62, base64), whose alphabet the tests use:

* chi-squared uniformity of the symbol counts over the alphabet,
* number of runs of one character class (lower, upper, digit, other),
* lag-1 serial correlation of the symbols' ranks.

Each test has a two-sided or upper p-value under "drawn evenly from the
alphabet"; Fisher's sum of the three must not reject (``MIN_RANDOM``). What
passes is then held against the opposite null, "ordinary text in this alphabet":
letters that follow each other as in the corpus's own words (``letter_model``),
symbols with the collision rate of words and rare changes of class. Its p-value
falls with the length of the run, so a short run needs a far more even look
than a long one. Benjamini-Hochberg over these p-values, in strata of encoding
and length (powers of two), bounds the share of false discoveries at
``FALSE_DISCOVERIES``.

All of it is DataFrame expressions. The p-values are gathered as counts on a
fixed grid of log p-values, so the step to the driver is bounded by strata times
grid, whatever the corpus.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltframe.llm.common import stored, table

#: Fixed values of the known forms: kind, pattern, group that must have a length, that length.
#: Where a pattern can't begin inside a match that is too short, it asks for the length itself.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]{14,}", 0, 18), ("hex", "[0-9a-f]{16,}", 0, 16)]

MIN_RUN = 12
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
MIN_RANDOM = 1e-3
FALSE_DISCOVERIES = 1e-3
#: Grid of -log10(p): steps of 0.05 up to 40.
GRID, GRID_TOP = 0.05, 800

#: Name, pattern of the whole run, symbols in rank order.
ENCODINGS = [
    ("hex", "[0-9a-f]+|[0-9A-F]+", "0123456789abcdef"),
    ("lower", "[a-z]+", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "[A-Z]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "[A-Z2-7]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "[a-z0-9]+", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("letters", "[A-Za-z]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "[A-Za-z0-9]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "[A-Za-z0-9+/]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "[A-Za-z0-9_-]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
FITS = "^(?:" + "|".join(pattern for _, pattern, _ in ENCODINGS) + ")$"
#: Known forms that lie inside one run of ``RUN``.
KNOWN = "AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}"
#: Matches whose places are summed up together.
CHUNK = 128
#: Share of even draws in the letter model, and how much the log probabilities of
#: neighbouring pairs of a text vary together.
EVEN_SHARE, TOGETHER = 0.02, 2.0
#: Chance that two symbols of ordinary text agree, and that neighbours differ in class.
TEXT_COLLISIONS, TEXT_CHANGES = 0.07, 0.12

ROW = ["row1", "row2"]
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once, not wherever it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums(lengths: Column) -> Column:
    """For each of an array of lengths, the sum of those before it. Sums are made
    in chunks, and chunks of chunks are few, so the work follows the array's
    length although every step of a fold copies what it has gathered."""
    def along(xs: Column, first: Column) -> Column:
        done = F.aggregate(xs, F.array(first), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))
        return F.slice(done, 1, F.size(xs))

    def chunked(xs: Column) -> Column:
        n = F.ceil(F.size(xs) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.slice(xs, (i - 1) * CHUNK + 1, CHUNK))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    some = _once(chunked(lengths), lambda chunks: _once(
        along(F.transform(chunks, total), F.lit(0)),
        lambda first: F.flatten(F.transform(chunks, lambda xs, i: along(xs, F.get(first, i))))))
    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(some)


def _found(text: Column, pattern: str, group: int) -> Column:
    """Leftmost non-overlapping matches as ``gap`` (the text before each), ``whole``
    and ``part``: the pieces between them, as ``split`` gives them, tell the places.
    A text without a match is searched once."""
    def parted(whole: Column) -> Column:
        part = F.transform(whole, lambda w: F.regexp_extract(w, pattern, group)) if group else whole
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
        return F.when(F.size(whole) > 0, F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part")))
    found = _once(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), parted)
    return F.coalesce(found, F.array().cast("array<struct<gap:string,whole:string,part:string>>"))


def _spans(found: Column, kind: str, least: int) -> Column:
    """Spans of those of ``found`` whose part has ``least`` characters."""
    def placed(all_: Column) -> Column:
        lengths = F.transform(all_, lambda m: F.length(m["gap"]) + F.length(m["whole"]))

        def span(m: Column, before: Column) -> Column:
            start = before + F.length(m["gap"])
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"),
                            (start + F.length(m["whole"])).alias("end"), m["part"].alias("value"))
        spans = _once(_once(lengths, _sums), lambda sums: F.transform(all_, lambda m, i: span(m, F.get(sums, i))))
        return F.when(F.size(all_) > 0, F.filter(spans, lambda s: F.length(s["value"]) >= least).cast(SPAN))
    return F.coalesce(_once(found, placed), F.array().cast(SPAN))


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    return _spans(_found(text, pattern, group), kind, least)


def _masked(text: Column, found: Column, pattern: str, least: int) -> Column:
    """``text`` with the characters of such matches replaced by blanks."""
    part = F.array_join(F.transform(found, lambda m: F.concat(m["gap"], F.when(
        F.length(m["part"]) >= least, F.repeat(F.lit(" "), F.length(m["whole"]))).otherwise(m["whole"]))), "")
    return F.when(F.size(found) == 0, text).otherwise(F.concat(part, F.element_at(F.split(text, pattern, -1), -1)))


def _within(spans: Column, pattern: str) -> Column:
    """Matches of ``pattern`` of at least ``MIN_RUN`` characters in each of ``spans``."""
    def moved(span: Column) -> Column:
        return F.transform(_matches(span["value"], "random", pattern, 0, MIN_RUN), lambda m: F.struct(
            m["kind"].alias("kind"), (m["start"] + span["start"]).alias("start"),
            (m["end"] + span["start"]).alias("end"), m["value"].alias("value")))
    return F.flatten(F.transform(spans, moved))


def _pieces(run: Column) -> Column:
    """The spans of one run that the battery tests: what known keys and digests
    inside it leave, split until it fits an encoding."""
    def split(spans: Column, *patterns: str) -> Column:
        return _once(spans, lambda all_: _once(F.filter(all_, lambda s: ~s["value"].rlike(FITS)), lambda odd: F.when(
            F.size(odd) == 0, all_).otherwise(F.concat(F.filter(all_, lambda s: s["value"].rlike(FITS)),
                                                       *[_within(odd, p) for p in patterns]))))

    def cut(spans: Column) -> Column:
        return F.when(F.exists(spans, lambda s: s["value"].rlike(KNOWN)), _between(spans)).otherwise(spans)
    return split(split(cut(F.array(run).cast(SPAN)), "[^=]+=*"), "[^/+]+", "[^_-]+")


def _between(spans: Column) -> Column:
    """What is left of ``spans`` between the known forms in them."""
    def left(span: Column) -> Column:
        gaps = F.split(span["value"], KNOWN, -1)
        known = F.concat(F.transform(F.regexp_extract_all(span["value"], F.lit(f"({KNOWN})"), F.lit(1)),
                                     lambda k: F.length(k)), F.array(F.lit(0)))
        both = F.arrays_zip(gaps.alias("gap"), known.alias("known"))
        return _once(both, lambda b: _once(
            _sums(F.transform(b, lambda x: F.length(x["gap"]) + x["known"])),
            lambda sums: F.transform(b, lambda x, i: F.struct(
                F.lit("random").alias("kind"), (span["start"] + F.get(sums, i)).alias("start"),
                (span["start"] + F.get(sums, i) + F.length(x["gap"])).alias("end"), x["gap"].alias("value")))))
    return F.filter(F.flatten(F.transform(spans, left)), lambda s: F.length(s["value"]) >= MIN_RUN).cast(SPAN)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, within 0.3 % of its value (a closed form
    by Boerjesson and Sundberg)."""
    at = F.abs(z)
    tail = F.exp(-at * at / 2) / 2.5066282746310002 / (0.661 * at + 0.339 * F.sqrt(at * at + 5.51))
    return F.greatest(F.lit(1e-300), F.when(z >= 0, tail).otherwise(1 - tail))


def _product(ps: list[Column]) -> Column:
    q = ps[0]
    for p in ps[1:]:
        q = q * p
    return F.greatest(q, F.lit(1e-300))


def _fisher(q: Column, k: Column) -> Column:
    """Combined p-value of two or three independent ones: for k of them and
    their product q, q * sum_j (-ln q)^j / j!, j < k."""
    less = -F.log(q)
    return F.least(F.lit(1.0), q * (1 + less + F.when(k == 3, less * less / 2).otherwise(0.0)))


def with_encoding(runs: DataFrame) -> DataFrame:
    """``value`` with its encoding (null if none fits), the size and symbols of the
    alphabet, and the run without padding (``body``)."""
    name = F.lit(None).cast("string")
    for encoding, pattern, _ in reversed(ENCODINGS):
        name = F.when(F.col("value").rlike(f"^(?:{pattern})$"), F.lit(encoding)).otherwise(name)
    sizes = F.create_map(*[x for e, _, symbols in ENCODINGS for x in (F.lit(e), F.lit(len(symbols)))])
    alphabets = F.create_map(*[x for e, _, symbols in ENCODINGS for x in (F.lit(e), F.lit(symbols))])
    bare = F.rtrim(F.col("value"), F.lit("="))
    return (runs.withColumn("encoding", name).where("encoding IS NOT NULL")
            .withColumns({"k": sizes[F.col("encoding")], "symbols": alphabets[F.col("encoding")],
                          "body": F.when(F.col("encoding") == "hex", F.lower(bare)).otherwise(bare)}))


def letter_model(text: DataFrame) -> tuple[list[float], float, float]:
    """How letters follow each other in the distinct words of ``text`` (one string
    column): log probability of each of the 26 x 26 pairs given its first letter,
    and mean and variance of that over a word's pairs. Every word counts once, so
    what is copied often weighs no more."""
    words = (text.select(F.explode(F.split(F.lower(F.col(text.columns[0])), "[^a-z]+")).alias("w"))
             .where(F.length("w") >= 3).distinct())
    pairs = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, 2))
    counts = np.zeros((26, 26))
    for r in words.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[ord(r["pair"][0]) - 97, ord(r["pair"][1]) - 97] = r["n"]
    rows = counts.sum(axis=1, keepdims=True)
    given = (1 - EVEN_SHARE) * (counts + 1 / 26) / (rows + 1) + EVEN_SHARE / 26
    logs = np.log(given)
    share = (counts + 1e-9) / (counts + 1e-9).sum()
    mean = float((share * logs).sum())
    return logs.ravel().tolist(), mean, max(float((share * (logs - mean) ** 2).sum()), 0.1)


def _letter_pairs(body: Column, model: tuple[list[float], float, float]) -> Column:
    """P-value of the run's letter pairs being as unusual under the model."""
    logs, mean, variance = model
    table = F.split(F.lit(" ".join(f"{x:.6g}" for x in logs)), " ").cast("array<double>")
    codes = F.transform(F.split(F.lower(body), ""), lambda c: F.ascii(c) - 97)

    def test(codes: Column) -> Column:
        letter = lambda c: (c >= 0) & (c < 26)
        ends = F.zip_with(codes, F.slice(codes, 2, F.size(codes)), lambda a, b: F.when(
            letter(a) & F.coalesce(letter(b), F.lit(False)), F.get(table, a * 26 + b)))
        found = F.filter(ends, lambda x: x.isNotNull())
        n = F.size(found)
        total = F.aggregate(found, F.lit(0.0), lambda s, x: s + x)
        return F.when(n == 0, F.lit(1.0)).otherwise(
            1 - _upper_tail((total - n * mean) / F.sqrt(n * (variance * TOGETHER))) + 1e-300)
    return _once(codes, test)


def _statistics(runs: DataFrame, model: tuple[list[float], float, float]) -> DataFrame:
    """The battery over rows with ``encoding, k, symbols, body``: adds ``n``,
    ``p_random`` and ``p_text``."""
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    zero = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("squares"))

    def count(done: Column, c: Column) -> Column:  # sum of squared counts over sorted symbols
        run = F.when(c == done["last"], done["run"] + 1).otherwise(F.lit(1.0))
        return F.struct(c.alias("last"), run.alias("run"), (done["squares"] + 2 * run - 1).alias("squares"))
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("x", "s1", "s2", "lag")])

    def moments(done: Column, c: Column) -> Column:  # last rank, sum, sum of squares, sum of neighbours' products
        x = F.instr(F.col("symbols"), c).cast("double")
        return F.struct(x.alias("x"), (done["s1"] + x).alias("s1"), (done["s2"] + x * x).alias("s2"),
                        (done["lag"] + done["x"] * x).alias("lag"))
    kinds = F.translate("body", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-",
                        "a" * 26 + "A" * 26 + "0" * 10 + "+" * 4)
    for kind in "aA0+":  # a maximal run of one class becomes one character
        kinds = F.regexp_replace(kinds, f"[{kind}]+", kind)
    changes = F.length(kinds).cast("double") - 1
    first = F.instr(F.col("symbols"), F.substring("body", 1, 1)).cast("double")
    mean = F.col("m.s1") / n
    spread = F.col("m.s2") - n * mean * mean
    lagged = F.col("m.lag") - mean * (2 * F.col("m.s1") - first - F.col("m.x")) + (n - 1) * mean * mean
    got = (runs.withColumn("n", F.length("body"))
           .withColumn("squares", F.aggregate(F.array_sort(F.split("body", "")), zero, count, lambda d: d["squares"]))
           .withColumn("changes", F.length(kinds).cast("double") - 1)
           .withColumn("m", F.aggregate(F.split("body", ""), none, moments))
           .withColumn("serial", F.when(spread > 1e-9, lagged / spread).otherwise(F.lit(1.0))))
    squares, ic, e = F.col("squares"), TEXT_COLLISIONS, TEXT_CHANGES
    # under "even draws": X^2 has mean k - 1 and variance 2 (k - 1)(n - 1) / n
    chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    same = F.col("same_class")
    got = got.withColumn("same_class", F.when(F.col("encoding") == "hex", 0.53125)
                         .when(F.col("encoding") == "base32", 0.6953125).when(F.col("encoding") == "base36", 0.5987654)
                         .when(F.col("encoding") == "letters", 0.5).otherwise(0.375))
    one_class = F.col("encoding").isin("lower", "upper")  # no changes of class to count
    runs_z = F.when(one_class, F.lit(0.0)).otherwise(
        (F.col("changes") - (n - 1) * (1 - same)) / F.sqrt((n - 1) * same * (1 - same)))
    serial_z = (F.col("serial") + 1 / n) * F.sqrt(n)
    both = lambda z: F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))
    # under "ordinary text": agreements among pairs, and class changes, are binomial-like
    agree = (squares - n) / 2
    pairs = n * (n - 1) / 2
    text_chi = (agree - pairs * ic) / F.sqrt(pairs * ic * (1 - ic) + n * (n - 1) * (n - 2) * 0.0022)
    text_runs = F.when(one_class, F.lit(1.0)).otherwise(
        _upper_tail((F.col("changes") - (n - 1) * e) / F.sqrt((n - 1) * e * (1 - e))))
    # one column after the other, so that none is worked out again inside the next
    got = got.withColumns({"chi": chi, "runs_z": runs_z, "serial_z": serial_z, "text_chi": text_chi,
                           "text_runs": text_runs, "pairs": _letter_pairs(F.col("body"), model)})
    got = got.withColumns({
        "q_random": _product([_upper_tail(F.col("chi")), both(F.col("runs_z")), both(F.col("serial_z"))]),
        "q_text": _product([1 - _upper_tail(F.col("text_chi")) + 1e-300, F.col("text_runs"), F.col("pairs")])})
    return got.withColumns({"p_random": _fisher(F.col("q_random"), F.lit(3)),
                            "p_text": _fisher(F.col("q_text"), F.when(one_class, 2).otherwise(3))})


def _thresholds(tested: DataFrame) -> DataFrame:
    """Per stratum the largest grid cell that Benjamini-Hochberg admits. The
    counts on the grid, not the p-values, are sorted."""
    cells = tested.groupBy("encoding", "band", "cell").agg(F.count(F.lit(1)).alias("m"))
    below = Window.partitionBy("encoding", "band").orderBy(F.desc("cell"))
    every = Window.partitionBy("encoding", "band")
    # a cell's p-value is its upper end, 10^(-cell * GRID)
    return (cells.withColumn("rank", F.sum("m").over(below)).withColumn("all", F.sum("m").over(every))
            .where(F.pow(F.lit(10.0), -F.col("cell") * GRID) <= F.col("rank") / F.col("all") * FALSE_DISCOVERIES)
            .groupBy("encoding", "band").agg(F.min("cell").alias("least_cell")))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``base`` and ``random``, arrays of
    ``(kind, start, end, value)`` in code points, ``end`` exclusive, ordered by
    start and then by kind.

    A null text counts as empty; null ids and repeated rows are kept; an empty
    table gives no rows; further columns are ignored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rank = F.create_map(*[x for i, (k, *_) in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    # each text is searched once for each kind; what is found serves spans and blanks
    known = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", *[_found(F.col("text"), pattern, group).alias(k) for k, pattern, group, _ in KINDS])
    keyed = F.transform(F.flatten(F.array(*[_spans(F.col(k), k, least) for k, _, _, least in KINDS])),
                        lambda s: F.struct(s["start"], rank[s["kind"]].alias("order"), s["kind"], s["end"], s["value"]))
    spans = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"]))
    # blanks in place of assignments part the runs; other known forms lie inside a run
    kind, pattern, _, least = KINDS[0]
    plain = _masked(F.col("text"), F.col(kind), pattern, least)
    runs = F.flatten(F.transform(_matches(F.col("plain"), "random", RUN, 0, MIN_RUN), _pieces))
    found = stored(known.select("id", spans.alias("base"), plain.alias("plain")).select("id", "base", runs.alias("runs")),
                   "secret-spans")
    tested = (found.where(F.size("runs") > 0).select(F.explode("runs.value").alias("value")).distinct())
    tested = with_encoding(tested).where(F.length("body") >= MIN_RUN - 4)
    tested = (_statistics(tested, letter_model(docs.select(F.col(text_col).alias("text"))))
              .withColumn("band", F.floor(F.log2("n")).cast("int"))
              .withColumn("cell", F.least(F.lit(GRID_TOP), F.floor(-F.log10("p_text") / GRID)).cast("int"))
              .select("value", "encoding", "band", "cell", "p_random"))
    tested = stored(tested, "secret-tests")
    good = (tested.join(_thresholds(tested), ["encoding", "band"])
            .where((F.col("cell") >= F.col("least_cell")) & (F.col("p_random") >= MIN_RANDOM)).select("value"))
    # 128 bits stand for a row: equal rows have equal results
    row = [F.xxhash64(F.lit(i), "id", "base", "runs").alias(c) for i, c in enumerate(ROW)]
    # each run of a document looks its value up; a document's own runs come together again
    hits = (found.where(F.size("runs") > 0).select(*row, "runs").select(*ROW, F.explode("runs").alias("span"))
            .select("*", F.col("span.value").alias("value")).distinct().join(good, "value"))
    # the two ways to split a run overlap: a span inside another says nothing new
    before = (Window.partitionBy(*ROW).orderBy("span.start", F.desc("span.end"))
              .rowsBetween(Window.unboundedPreceding, -1))
    hits = (hits.withColumn("reach", F.max("span.end").over(before))
            .where(F.col("reach").isNull() | (F.col("reach") < F.col("span.end")))
            .groupBy(*ROW).agg(F.array_sort(F.collect_list("span")).alias("random")))
    keyed = found.select("*", *row)
    by_start = F.array_sort(F.transform("random", lambda s: F.struct(s["start"], s["kind"], s["end"], s["value"])))
    back = F.transform(by_start, lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"]))
    return keyed.join(hits, ROW, "left").select(F.col("id").alias(id_col), "base",
                                                  F.coalesce(back, F.array().cast(SPAN)).alias("random"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    got = scan_secrets(table(spark, sf_dir, "documents"))
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    order = F.create_map(*[x for i, k in enumerate(["assign", "access", "hex", "random"])
                           for x in (F.lit(k), F.lit(i))])
    merged = F.array_sort(F.transform(F.concat("base", "random"), lambda s: F.struct(
        s["start"], order[s["kind"]].alias("order"), s["kind"], s["end"])))
    return got.select("doc_id", *[count(k) for k, *_ in KINDS], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                      _listed(merged).alias("spans"))
