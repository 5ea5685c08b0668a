"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens. Columns only.

Candidates are runs of 20 or more characters of the base64 alphabets. For each, the narrowest alphabet
that holds it is inferred, and three statistics ask how unlikely such a string is where text-like strings
stand (the null hypothesis): the chi-squared distance from uniform use of the alphabet, the number of runs
of character classes, and the serial correlation of neighbouring codes. Their z-scores are combined with
fixed weights into one p-value, on a grid of tenths of log10. Longer strings have more power, so the
candidates of the corpus are judged in classes of length: in each, Benjamini and Hochberg's step-up rule on
the counted p-values of all documents gives the cut-off that holds the false-discovery rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order in which ties are sorted.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a maximal run of 18 or more: shorter ones hold no longer one
HEX = r"[0-9a-f]{16,}"
ASSIGN_MIN = 12

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Lower ends of the classes of length.
LENGTHS = (20, 24, 32, 48, 64)
#: Alphabets from the narrowest to the widest: pattern, size.
ALPHABETS = (
    (r"^[0-9]+$", 10), (r"^([0-9a-f]+|[0-9A-F]+)$", 16), (r"^([a-z]+|[A-Z]+)$", 26), (r"^[A-Z2-7]+$", 32),
    (r"^([a-z0-9]+|[A-Z0-9]+)$", 36), (r"^[A-Za-z]+$", 52), (r"^[A-Za-z0-9]+$", 62),
)
WIDEST = 64
CODES = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_="
#: Sum of squared letter shares in text; share of class changes and serial correlation in text-like tokens.
TEXT_SHARE, TEXT_CHANGES, TEXT_SERIAL = 0.065, 0.15, 0.3
#: Tenths of -log10 p that are told apart.
TOP = 200
_SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def _found(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Spans of all matches with their text (`part`), leftmost first, in code points.

    What lies between the matches tells their places."""
    empty = "array<struct<start:int,rank:int,end:int,kind:string,part:string>>"
    sizes = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("n"), m.alias("part")),
    )
    if group:
        part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        sizes = F.zip_with(sizes, part, lambda s, p: F.struct(s["gap"].alias("gap"), s["n"].alias("n"), p.alias("part")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(empty).alias("out"))

    def step(state: Column, s: Column) -> Column:
        begin, end = state["at"] + s["gap"], state["at"] + s["gap"] + s["n"]
        span = F.struct(
            begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), s["part"].alias("part")
        )
        # the last gap has no match behind it
        return F.when(s["n"].isNull(), state).otherwise(F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out")))

    spans = F.aggregate(sizes, start, step, lambda state: state["out"])
    if least:
        spans = F.filter(spans, lambda s: F.length(s["part"]) >= least)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(empty))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")).cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the fixed kinds, sorted by start, then kind."""
    parts = [_found(text, "assign", ASSIGN, 2, ASSIGN_MIN), _found(text, "access", ACCESS), _found(text, "hex", HEX)]
    return F.array_sort(F.concat(*[_bare(p) for p in parts]))


def evidence(spans: Column) -> Column:
    """The spans (start, end, part) with `tenths`: tenths of -log10 of the part's combined p-value, 0 to 200.

    Digits alone have none. The steps are transforms of one array, each computed once."""
    keep = lambda s: [s["start"].alias("start"), s["end"].alias("end")]

    def alphabet(s: Column) -> Column:
        size = F.lit(float(WIDEST))
        for pattern, letters in reversed(ALPHABETS):
            size = F.when(s["token"].rlike(pattern), F.lit(float(letters))).otherwise(size)
        runs = s["token"]
        # separators join words in names and paths: they are no class of their own
        for many, one in (("[^a-zA-Z0-9]+", ""), ("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0")):
            runs = F.regexp_replace(runs, many, one)
        chars = F.filter(F.split(s["token"], ""), lambda c: c != "")
        return F.struct(
            *keep(s), size.alias("size"), F.length(s["token"]).cast("double").alias("n"),
            (F.length(runs).cast("double") - 1).alias("changes"), F.transform(chars, lambda c: F.instr(F.lit(CODES), c).cast("double")).alias("codes"),
        )

    def sums(s: Column) -> Column:
        codes = s["codes"]
        squares = F.aggregate(
            F.array_distinct(codes), F.lit(0.0),
            lambda total, c: total + F.pow(F.size(F.filter(codes, lambda x: x == c)).cast("double"), F.lit(2.0)),
        )
        mean = F.aggregate(codes, F.lit(0.0), lambda total, c: total + c) / F.greatest(s["n"], F.lit(1.0))
        return F.struct(
            *keep(s), s["size"].alias("size"), s["n"].alias("n"), s["changes"].alias("changes"), squares.alias("squares"),
            codes.alias("codes"), mean.alias("mean"),
        )

    def centre(s: Column) -> Column:
        # a step of its own: inside the last one's transform the mean would be computed for every code
        return F.struct(
            *keep(s), *[s[k].alias(k) for k in ("size", "n", "changes", "squares")],
            F.transform(s["codes"], lambda c: c - s["mean"]).alias("centred"),
        )

    def scores(s: Column) -> Column:
        size, n, centred = s["size"], F.greatest(s["n"], F.lit(2.0)), s["centred"]
        chi = size / n * s["squares"] - n
        apart = F.greatest(size * TEXT_SHARE - 1, F.lit(0.5)) * n
        z_chi = (chi - (size - 1 + apart)) / F.sqrt(2 * (size - 1 + 2 * apart))
        z_runs = F.when(size == 26, F.lit(0.0)).otherwise(
            -(s["changes"] - (n - 1) * TEXT_CHANGES) / F.sqrt((n - 1) * (TEXT_CHANGES * (1 - TEXT_CHANGES)))
        )
        spread = F.aggregate(centred, F.lit(0.0), lambda total, c: total + c * c)
        pairs = F.zip_with(centred, F.slice(centred, 2, F.greatest(F.size(centred) - 1, F.lit(0))), lambda x, y: F.coalesce(x * y, F.lit(0.0)))
        serial = F.aggregate(pairs, F.lit(0.0), lambda total, c: total + c) / F.when(spread > 0, spread)
        z_serial = (F.abs(F.coalesce(serial, F.lit(1.0))) - TEXT_SERIAL) * F.sqrt(n)
        return F.struct(
            *keep(s), ((s["n"] >= 2) & (size != 10)).alias("tested"), ((2 * z_chi + 2 * z_runs + z_serial) / 3).alias("z"),
        )

    def logarithm(s: Column) -> Column:
        # the normal distribution's lower tail by a logistic of a cubic: -ln p = ln(1 + exp(w))
        w = -(s["z"] * 1.5976 + s["z"] * s["z"] * s["z"] * 0.07056)
        tenths = F.when(w > 30, w).otherwise(F.log1p(F.exp(F.least(w, F.lit(30.0))))) / F.log(F.lit(10.0)) * 10
        return F.struct(
            *keep(s), F.when(s["tested"], F.floor(F.least(tenths, F.lit(float(TOP)))).cast("int")).otherwise(F.lit(0)).alias("tenths")
        )

    tokens = F.transform(spans, lambda s: F.struct(*keep(s), F.rtrim(s["part"], F.lit("=")).alias("token")))
    for step in (alphabet, sums, centre, scores, logarithm):
        tokens = F.transform(tokens, step)
    return tokens


def _length_class(n: Column) -> Column:
    found = F.lit(LENGTHS[0])
    for low in LENGTHS[1:]:
        found = F.when(n >= low, F.lit(low)).otherwise(found)
    return found


def cut_offs(texts: DataFrame, rate: float) -> dict[int, int]:
    """Length class -> least evidence of a discovery, from all candidates of the table's `text`."""
    tested = texts.select(F.explode(evidence(_found(F.col("text"), "random", CANDIDATE))).alias("c"))
    counted = (
        tested.select(_length_class(F.col("c.end") - F.col("c.start")).alias("length"), "c.tenths")
        .groupBy("length", "tenths")
        .count()
        .collect()  # at most 5 x 201 rows
    )
    cuts = {}
    for low in LENGTHS:
        of = {r["tenths"]: r["count"] for r in counted if r["length"] == low}
        tests, beyond, cuts[low] = sum(of.values()), 0, TOP + 1
        for tenths in range(TOP, 0, -1):
            beyond += of.get(tenths, 0)
            if beyond and tests * 10 ** (-tenths / 10) <= rate * beyond:
                cuts[low] = tenths
    return cuts


def with_spans(df: DataFrame, text: str, spans: str, cuts: dict[int, int]) -> DataFrame:
    """The table with a column of all spans of a text, sorted by start, then kind: the base ones, and the
    random ones apart from them. Adds and drops two columns beside it, named after `spans`."""
    base, random = f"{spans}_base", f"{spans}_random"
    cut = F.create_map(*[F.lit(x) for pair in sorted(cuts.items()) for x in pair])
    df = df.withColumn(base, base_spans(F.col(text))).withColumn(random, evidence(_found(F.col(text), "random", CANDIDATE)))
    chosen = F.filter(
        random,
        lambda r: (r["tenths"] >= cut[_length_class(r["end"] - r["start"])])
        & ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
    )
    kind = KINDS.index("random")
    chosen = F.transform(
        chosen, lambda r: F.struct(r["start"].alias("start"), F.lit(kind).alias("rank"), r["end"].alias("end"), F.lit("random").alias("kind")).cast(_SPAN)
    )
    return df.withColumn(spans, F.array_sort(F.concat(F.col(base), chosen))).drop(base, random)


def find_secrets(docs: DataFrame, rate: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text, spans (array of start, rank, end, kind; code points, end exclusive).

    `docs` needs an id and a text; other columns are ignored, whatever their names. A null text counts as
    empty and has no spans. Null and repeated ids keep their rows; equal texts have equal spans. An empty
    table gives no rows. Whole texts are scanned; the cut-offs come from all candidates of the table.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_spans(texts, "text", "spans", cut_offs(texts, rate))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of overlapping spans replaced by the mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.when(
            s["start"] >= state["at"],
            F.struct(s["end"].alias("at"), F.concat(state["out"], gap, F.lit(mark)).alias("out")),
        ).otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    whole = F.aggregate(spans, start, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
