"""Secret scans by patterns and by a battery of randomness tests, in DataFrame functions only.

Base spans come from three patterns. The battery adds spans: what base spans leave of a run of at
least 20 letters, digits and ``+ / _ -`` is a candidate if it has a digit and a letter or letters of
both cases. Its encoding is inferred from its characters and three tests of the hypothesis "drawn
uniformly from that alphabet" are taken: chi-squared over the alphabet in a few pooled cells (so
that short strings have enough expected in each), runs above and below the alphabet's middle (too
few), and lag-one serial correlation. Fisher's rule combines them: small values are not random.

False-discovery control is on what is reported. The null hypothesis of a candidate is "an ordinary
name": names are made in the same way for each family of encodings and each length (powers of two,
as the tests' power depends on length) from the corpus's words, of which each that any of its texts has stands in a name of each of these,
in lower, upper and camel case and with separators, most with a number. A candidate's score
is the number of names of its family and length that have its encoding and look at least as random,
and its p-value the share of all names of that family and length, whatever their encoding, whose own
score is as low: one order over the family, so that an ordinary name has a p-value of t or less
with probability t at most, however names are spread over encodings. In each stratum the step-up rule takes the largest threshold t for which
m * t <= FDR * (number of p-values <= t) over the m candidates of all documents, so that the
expected share of names among what is reported is FDR at most. What the battery itself
rejects (combined value below ALPHA) is never reported, whatever names look like; it counts in m.
Candidates within the threshold are added as kind ``random``.

Counts by stratum and grid cell and the number of words are all that the driver sees. There are as
many names as candidates, NAMES for each stratum at least in which anything could be reported, and so many that every word
is in one, so that the p-values get finer with the corpus. A corpus without words in ASCII letters has names made of FALLBACK words.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanworks.llm.common import free_name, materialise, with_rank

FDR = 0.05
MARK = "[SECRET]"
# The base patterns, by kind.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
MIN_RUN = 20
#: Combined values below this are not random.
ALPHA = 1e-3
#: Ordinary names for each family and length at least.
NAMES = 2048
WORD = r"(?<![A-Za-z0-9+/_-])[A-Za-z]{3,12}(?![A-Za-z0-9+/_-])"
#: Words of ordinary names where the corpus has none to draw from.
FALLBACK = ("account", "address", "archive", "button", "cache", "client", "column", "config", "counter", "customer", "delete", "document", "element", "export", "field", "filter", "handler", "header", "image", "import", "index", "insert", "invoice", "label", "language", "letter", "manager", "message", "module", "number", "option", "order", "package", "parser", "person", "printer", "profile", "query", "reader", "record", "report", "request", "response", "section", "select", "server", "service", "session", "setting", "status", "stream", "string", "system", "table", "thread", "title", "update", "value", "vector", "window", "writer")
_KINDS = ("assign", "access", "hex", "random")
_RUN_BITS = 8  # matches of a run, as a power of two
_PAGE_BITS = 12  # code points of a page, as a power of two
_GRID = 20  # cells for each power of ten
_CELLS = 400
_BUCKETS = (4, 5, 6, 7)  # powers of two of a length, the last one without end
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COMMON = "aeinorst"  # letters that are common in prose
_RARE = "".join(c for c in _LOWER if c not in _COMMON)
_LETTERS = [_COMMON, _RARE, _COMMON.upper(), _RARE.upper()]
#: (encoding, family, pattern, alphabet, pooled cells of the alphabet); the first that fits is inferred.
_ENCODINGS = (
    ("hex", "lower", r"^[0-9a-f]+$", _DIGITS + "abcdef", ["0123", "4567", "89ab", "cdef"]),
    ("hex-upper", "upper", r"^[0-9A-F]+$", _DIGITS + "ABCDEF", ["0123", "4567", "89AB", "CDEF"]),
    ("base32", "upper", r"^[A-Z2-7]+$", _UPPER + "234567", ["234567", *_LETTERS[2:]]),
    ("base36", "lower", r"^[0-9a-z]+$", _DIGITS + _LOWER, [_DIGITS, *_LETTERS[:2]]),
    ("base36-upper", "upper", r"^[0-9A-Z]+$", _DIGITS + _UPPER, [_DIGITS, *_LETTERS[2:]]),
    ("base62", "camel", r"^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER, [_DIGITS, *_LETTERS]),
    ("base64", "joined", r"^[0-9A-Za-z+/]+$", _DIGITS + _UPPER + _LOWER + "+/", [_DIGITS + "+/", *_LETTERS]),
    ("base64-url", "joined", r"^[0-9A-Za-z_-]+$", _DIGITS + _UPPER + _LOWER + "-_", [_DIGITS + "-_", *_LETTERS]),
    ("mixed", "joined", r"^.*$", _DIGITS + _UPPER + _LOWER + "+/-_", [_DIGITS + "+/-_", *_LETTERS]),
)
_FAMILY = {e[0]: e[1] for e in _ENCODINGS}
_FAMILIES = ("lower", "upper", "camel", "joined")


def _upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, by a rational approximation (error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    # The approximation's coefficients.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, q).otherwise(1 - q)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("double"), lambda acc, x: acc + x)


def _whole_sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda acc, x: acc + x)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _found(t: Column, pattern: str, least: str, part: int, there: Column) -> Column:
    """(start, end, body, ok) of each leftmost match of ``pattern`` in ``t`` whose group ``part`` matches ``least``;
    part 0: each match.

    A match starts after the gaps and matches before it: gaps are what the pattern splits the text
    into. Their lengths are summed in runs, so that work stays small for texts of very many
    matches. Lengths are in code points. Texts of which ``there`` is false have none.
    """
    hits = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    keep = F.regexp_extract_all(t, F.lit(pattern), F.lit(part)) if part else F.lit(None).cast("array<string>")
    parts = F.struct(hits.alias("hits"), F.transform(F.split(t, pattern, -1), F.length).alias("gaps"), keep.alias("keep"))

    def stepped(p: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), F.transform(p["hits"], F.length))
        return F.struct(p["hits"].alias("hits"), p["keep"].alias("keep"), F.zip_with(p["gaps"], before, lambda x, y: x + y).alias("steps"))

    def summed(p: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(p["steps"]), _RUN_BITS)), lambda r: _whole_sum(F.slice(p["steps"], F.shiftleft(r, _RUN_BITS) + 1, F.lit(1 << _RUN_BITS))))
        return F.struct(p["hits"].alias("hits"), p["keep"].alias("keep"), p["steps"].alias("steps"), runs.alias("runs"))

    def placed(p: Column) -> Column:
        def at(hit: Column, i: Column) -> Column:
            run = F.shiftright(i, _RUN_BITS)
            start = _whole_sum(F.slice(p["runs"], F.lit(1), run)) + _whole_sum(F.slice(p["steps"], F.shiftleft(run, _RUN_BITS) + 1, i - F.shiftleft(run, _RUN_BITS) + 1))
            return F.struct(start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("body"), (F.element_at(p["keep"], i + 1).rlike(least) if part else F.lit(True)).alias("ok"))

        return F.filter(F.transform(p["hits"], at), lambda s: s["ok"])

    found = F.when(there, _let(_let(_let(parts, stepped), summed), placed))
    return F.coalesce(found, F.expr("cast(array() as array<struct<start:int,end:int,body:string,ok:boolean>>)"))


def _pages(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(f"(?s).{{1,{1 << _PAGE_BITS}}}"), F.lit(0))


def _outside(t: Column, spans: Column, mark) -> Column:
    """``t`` with each group of overlapping ``spans`` (sorted by start) replaced by ``mark`` of its length."""
    kind = "struct<from:int,to:int>"
    gap = lambda x, y: F.array(F.struct(x.alias("from"), y.alias("to")))

    def step(acc: Column, s: Column) -> Column:
        more = F.when(s["start"] >= acc["at"], F.concat(acc["gaps"], gap(acc["at"], s["start"]))).otherwise(acc["gaps"])
        return F.struct(more.alias("gaps"), F.greatest(acc["at"], s["end"]).alias("at"))

    start = F.struct(F.expr(f"cast(array() as array<{kind}>)").alias("gaps"), F.lit(0).alias("at"))
    gaps = F.aggregate(spans, start, step, lambda acc: F.concat(acc["gaps"], gap(acc["at"], F.length(t))))

    def joined(p: Column) -> Column:
        def piece(g: Column, i: Column) -> Column:
            first = F.shiftright(g["from"], _PAGE_BITS)
            held = F.array_join(F.slice(p["pages"], first + 1, F.shiftright(g["to"] - 1, _PAGE_BITS) - first + 1), "")
            own = F.when(g["to"] > g["from"], F.substr(held, g["from"] - F.shiftleft(first, _PAGE_BITS) + 1, g["to"] - g["from"])).otherwise("")
            return F.when(i == 0, own).otherwise(F.concat(mark(g["from"] - F.element_at(p["gaps"], i)["to"]), own))

        return F.array_join(F.transform(p["gaps"], piece), "")

    return _let(F.struct(_pages(t).alias("pages"), gaps.alias("gaps")), joined)


def _battery(cands: Column) -> Column:
    """(start, end, encoding, bucket, cell) of each candidate (start, end, body); cell: its combined value on the grid."""

    def inferred(c: Column) -> Column:
        at = F.coalesce(*[F.when(c["body"].rlike(e[2]), F.lit(k + 1)) for k, e in enumerate(_ENCODINGS)])
        return F.struct(*[c[k].alias(k) for k in ("start", "end", "body")], at.alias("at"))

    def told(c: Column) -> Column:
        pick = lambda k: F.element_at(F.split(F.lit(" ".join(e[k] if isinstance(e[k], str) else "|".join(e[k]) for e in _ENCODINGS)), " "), c["at"])
        return F.struct(*[c[k].alias(k) for k in ("start", "end", "body")], F.length(c["body"]).cast("double").alias("n"), pick(0).alias("encoding"), pick(3).alias("alphabet"), F.split(pick(4), r"\|").alias("cells"))

    def counted(c: Column) -> Column:
        k = F.length(c["alphabet"]).cast("double")

        def gap(cell: Column) -> Column:
            due = c["n"] * F.length(cell) / k
            return F.pow(c["n"] - F.length(F.call_function("translate", c["body"], cell, F.lit(""))) - due, F.lit(2.0)) / due

        places = F.transform(F.split(c["body"], "(?!^)(?!$)", -1), lambda x: (F.instr(c["alphabet"], x) - 1).cast("double"))
        return F.struct(*[c[x].alias(x) for x in ("start", "end", "n", "encoding")], k.alias("k"), (F.size(c["cells"]) - 1).cast("double").alias("df"), _sum(F.transform(c["cells"], gap)).alias("chi"), places.alias("v"))

    def centred(c: Column) -> Column:
        mean = _sum(c["v"]) / c["n"]
        high = F.transform(c["v"], lambda x: F.when(x * 2 >= c["k"], 1).otherwise(0))
        return F.struct(*[c[k].alias(k) for k in ("start", "end", "n", "encoding", "df", "chi", "v")], mean.alias("mean"), high.alias("high"))

    def tested(c: Column) -> Column:
        df = c["df"]
        z_chi = (F.pow(c["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        later = lambda a: F.slice(a, F.lit(2), F.size(a) - 1)
        sooner = lambda a: F.slice(a, F.lit(1), F.size(a) - 1)
        turns = _whole_sum(F.zip_with(sooner(c["high"]), later(c["high"]), lambda a, b: F.abs(a - b))) + 1
        z_runs = (turns - (c["n"] + 1) / 2) / F.sqrt((c["n"] - 1) / 4)
        gap = lambda x: x - c["mean"]
        spread = _sum(F.transform(c["v"], lambda x: gap(x) * gap(x)))
        lagged = _sum(F.zip_with(sooner(c["v"]), later(c["v"]), lambda a, b: gap(a) * gap(b)))
        z_serial = F.when(spread > 0, (lagged / spread + 1 / c["n"]) * F.sqrt(c["n"])).otherwise(F.sqrt(c["n"]))
        return F.struct(*[c[k].alias(k) for k in ("start", "end", "n", "encoding")], z_chi.alias("a"), z_runs.alias("b"), z_serial.alias("c"))

    def graded(c: Column) -> Column:
        log = lambda p: -F.ln(F.greatest(p, F.lit(1e-30)))
        y = log(_upper_tail(c["a"])) + log(_upper_tail(-c["b"])) + log(F.least(F.lit(1.0), 2 * _upper_tail(F.abs(c["c"]))))
        tenths = (y - F.ln(1 + y + y * y / 2)) / F.ln(F.lit(10.0))  # Fisher's rule for three tests
        cell = F.least(F.lit(_CELLS), F.floor(F.greatest(tenths, F.lit(0.0)) * _GRID + 1e-9)).cast("int")
        bucket = F.least(F.lit(_BUCKETS[-1]), F.floor(F.log2(c["n"])).cast("int"))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"), bucket.alias("bucket"), cell.alias("cell"))

    for step in (inferred, told, counted, centred, tested, graded):
        cands = F.transform(cands, step)
    return cands


def _candidate(body: Column) -> Column:
    return (body.rlike("[0-9]") & body.rlike("[A-Za-z]")) | (body.rlike("[a-z]") & body.rlike("[A-Z]"))


def _span(k: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("ord"), F.lit(_KINDS[k]).alias("kind"), s["end"].alias("end"))


def _has_run(t: Column) -> Column:
    """Whether there is a run long enough for a candidate; access and hex spans lie in one."""
    return t.rlike(f"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_RUN}}}")


def _base(t: Column, run: Column) -> Column:
    """The base spans (start, ord, kind, end), sorted."""
    low = F.lower(t)
    named = F.contains(low, F.lit("passw")) | F.contains(low, F.lit("secret")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("api"))
    found = []
    for k, (pattern, least, part, there) in enumerate(((ASSIGN, r"^.{6,}$", 1, named), (ACCESS, r"AKIA[A-Z0-9]{16,}", 0, run & F.contains(t, F.lit("AKIA"))), (HEX, r"[0-9a-f]{24,}", 0, run))):
        # Runs of one class: a run that is long enough is matched whole by the long form alone.
        use = pattern if part else least
        found.append(F.transform(_found(t, use, least, part, there & t.rlike(use)), _span(k)))
    return F.array_sort(F.concat(*found))


def _candidates(t: Column, base: Column, run: Column) -> Column:
    """(start, end, body) of the candidates that base spans leave."""
    shown = F.when(F.size(base) > 0, _outside(t, base, lambda n: F.repeat(F.lit(" "), n))).otherwise(t)
    return F.filter(_found(shown, CANDIDATE, CANDIDATE, 0, run & shown.rlike(CANDIDATE)), lambda c: _candidate(c["body"]))


def _findings(text_col: str, run: str) -> Column:
    """(base, cands) of the text, where the column ``run`` tells whether it has a long run."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    judged = lambda x: F.struct(x.alias("base"), F.when(F.col(run), _battery(_candidates(t, x, F.col(run)))).alias("cands"))
    return _let(_base(t, F.col(run)), judged)


def with_findings(docs: DataFrame, text_col: str, base: str, cands: str, found: Column | None = None, run: str | None = None) -> DataFrame:
    """``docs`` with ``base`` (start, ord, kind, end), sorted, and ``cands``, the battery's results.

    ``found`` is ``_findings`` for the text and a free name ``run``, if the caller has it already.
    """
    run = run or free_name(docs, "run_")
    both = free_name(docs, "both_")
    df = docs.withColumn(run, _has_run(F.coalesce(F.col(text_col), F.lit(""))))
    # Through a generator of one row, as the optimiser would else copy the expression to each of its uses.
    df = df.select("*", F.explode(F.array(_findings(text_col, run) if found is None else found)).alias(both))
    return df.select(*docs.columns, F.col(both)["base"].alias(base), F.col(both)["cands"].alias(cands))


def candidate_counts(found: DataFrame, cands: str) -> DataFrame:
    """``encoding, bucket, cell, n`` over all candidates."""
    c = found.select(F.explode(cands).alias("c"))
    return c.groupBy(*[F.col(f"c.{k}").alias(k) for k in ("encoding", "bucket", "cell")]).agg(F.count(F.lit(1)).alias("n"))  # at most strata * cells


def corpus_words(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """(w, place): every word that a text has anywhere, with its place from 0 in an order by hash; and their number."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)))
    return with_rank(docs.select(F.explode(found).alias("w")).select(F.lower("w").alias("w")).distinct(), [F.xxhash64("w"), F.col("w")], "place")


def ordinary_names(words: DataFrame, count: int, strata: list[tuple[str, int]], each: int = NAMES) -> DataFrame:
    """``cands``: (start, end, body) of one name, made of the ``count`` ``words`` (w, place).

    In every (family, bucket) of ``strata`` each word stands in a name, whole and beside those that follow it by place.
    There are ``each`` names of a stratum at least; those beyond all words draw theirs.
    """
    spark = words.sparkSession
    draw = lambda n, *what: F.pmod(F.xxhash64("id", *[F.lit(w) if isinstance(w, str) else w for w in what]), (n if isinstance(n, Column) else F.lit(n)).cast("long")).cast("int")
    stratum = lambda k: F.element_at(F.split(F.lit(" ".join(str(_FAMILIES.index(x[0]) if k == 0 else x[1]) for x in strata)), " "), (F.col("id") % len(strata)).cast("int") + 1).cast("int")
    letters = words.agg(F.avg(F.length("w")).alias("n")).first()["n"]
    rows = []
    for s, (family, bucket) in enumerate(strata):
        # Names take low to low + span - 1 words in turn, so many that most of them have a length of the bucket.
        word = letters + (family == "joined")
        low = math.ceil(max(MIN_RUN, 1 << bucket) / word)
        span = max(1, int(min(192, 2 << bucket) / word) - low + 1)
        turn = span * low + span * (span - 1) // 2
        k, r = F.col("id"), F.col("id") % span
        start = F.floor(k / span) * turn + r * low + F.shiftright(r * (r - 1), 1)
        rows.append(spark.range(0, max(each, -(-count // turn) * span)).select((k * len(strata) + s).alias("id"), start.alias("at"), (r + low).alias("n")))
    pieces = functools.reduce(DataFrame.union, rows).select("id", "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    drawn = F.pmod(F.xxhash64("id", F.lit("word"), "i"), F.lit(count).cast("long"))
    placed = pieces.select("id", "i", F.when(F.col("at") + F.col("i") < count, F.col("at") + F.col("i")).otherwise(drawn).alias("place"))
    joined = placed.join(words, "place").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("words"))
    rows = joined.select("id", "words", stratum(0).alias("family"), F.when(stratum(1) < 5, 0).otherwise(draw(F.lit(2), "at")).alias("at"), draw(F.lit(4), "style").alias("style"))
    number = F.when((F.col("family") < 2) | (draw(4, "bare") > 0), (draw(F.pow(F.lit(10), 1 + draw(4, "digits")), "number")).cast("string")).otherwise("")

    def piece(p: Column) -> Column:
        i, w = p["i"], p["w"]
        cased = F.when(F.col("family") == 0, w).when(F.col("family") == 1, F.upper(w)).when(F.col("family") == 2, F.initcap(w)).when(draw(3, "case", i) == 0, F.initcap(w)).otherwise(w)
        mark = F.when(F.col("style") == 0, "/").when(F.col("style") == 1, "_").when((F.col("style") == 2) | (i % 2 == 0), "-").otherwise("/")
        return F.concat(cased, F.when(i == F.col("at"), number).otherwise(""), F.when(F.col("family") == 3, mark).otherwise(""))

    body = F.array_join(F.transform("words", piece), "")
    made = rows.select(body.alias("body"))
    one = F.array(F.struct(F.lit(0).alias("start"), F.length("body").alias("end"), F.col("body").alias("body")))
    return made.where(_candidate(F.col("body")) & (F.length("body") >= MIN_RUN)).select(one.alias("cands"))


def _last(alpha: float) -> int:
    return int(-math.log10(alpha) * _GRID + 1e-9)


def thresholds(candidates: dict[tuple[str, int, int], int], names: dict[tuple[str, int, int], int], fdr: float = FDR, alpha: float = ALPHA) -> dict[tuple[str, int], int]:
    """(encoding, bucket) to the last grid cell that is reported, by the step-up rule in each family and bucket.

    Both arguments count by (encoding, bucket, cell).
    """
    last = _last(alpha)
    out: dict[tuple[str, int], int] = {}
    for family, bucket in {(_FAMILY[e], b) for e, b, _ in candidates}:
        mine = {(e, cell): n for (e, b, cell), n in candidates.items() if _FAMILY[e] == family and b == bucket}
        null = {(e, cell): n for (e, b, cell), n in names.items() if _FAMILY[e] == family and b == bucket}
        m, every = sum(mine.values()), sum(null.values())
        score = {x: sum(n for (f, c), n in null.items() if f == x[0] and c <= x[1]) for x in {*mine, *null}}
        p = {x: (1 + sum(n for y, n in null.items() if score[y] <= score[x])) / (1 + every) for x in mine if x[1] <= last}
        ok = [t for t in sorted(set(p.values())) if m * t <= fdr * sum(mine[x] for x, y in p.items() if y <= t)]
        for (e, cell), y in p.items():
            if ok and y <= ok[-1]:
                out[e, bucket] = max(cell, out.get((e, bucket), 0))
    return out


def control(docs: DataFrame, text_col: str, counts: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], int]:
    """``thresholds`` for the candidates counted in ``counts``, with names from all words of ``docs``."""
    by_cell = lambda df: {(r["encoding"], r["bucket"], r["cell"]): r["n"] for r in df.collect()}
    candidates = by_cell(counts)
    strata = sorted({(_FAMILY[e], b) for e, b, cell in candidates if cell <= _last(ALPHA)})
    if not strata:
        return {}
    words, count = corpus_words(docs, text_col)
    if not count:
        words, count = docs.sparkSession.createDataFrame([(w, k) for k, w in enumerate(FALLBACK)], "w string, place long"), len(FALLBACK)
    names = ordinary_names(words, count, strata, max(NAMES, -(-sum(candidates.values()) // len(strata))))
    return thresholds(candidates, by_cell(candidate_counts(names.select(_battery(F.col("cands")).alias("cands")), "cands")), fdr)


def added(cands: Column, limits: dict[tuple[str, int], int]) -> Column:
    """The candidates within the thresholds, as spans of kind ``random``."""
    if not limits:
        return F.expr("cast(array() as array<struct<start:int,ord:int,kind:string,end:int>>)")
    table = F.create_map(*[x for (e, b), cell in sorted(limits.items()) for x in (F.lit(f"{e} {b}"), F.lit(cell))])
    kept = F.filter(F.coalesce(cands, F.expr("cast(array() as array<struct<start:int,end:int,encoding:string,bucket:int,cell:int>>)")), lambda c: c["cell"] <= F.coalesce(F.element_at(table, F.concat_ws(" ", c["encoding"], c["bucket"].cast("string"))), F.lit(-1)))
    return F.transform(kept, _span(3))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """A row for each row of ``docs``: id, ``base`` and ``spans``, arrays of (start, ord, kind, end).

    Offsets are code points, ends exclusive; spans are sorted by start, then kind as listed. Null
    texts count as empty; rows with a null or repeated id stay apart; other columns are not read.
    """
    one = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    found = materialise(with_findings(one, "text_", "base", "cands").drop("text_"), "findings")
    spans = F.array_sort(F.concat("base", added(F.col("cands"), control(one, "text_", candidate_counts(found, "cands"), fdr))))
    return found.select(F.col("id_").alias(id_col), "base", spans.alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = MARK, fdr: float = FDR) -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by ``mark``; overlapping spans become one mark.

    Null texts stay null. Columns are those of ``docs``. A first pass counts the candidates, for
    which it looks closely only at texts with a long run; texts are not written or shuffled.
    """
    base, cands, spans = (free_name(docs, x) for x in ("base_", "cands_", "spans_"))
    run = free_name(docs, "run_")
    found = _findings(text_col, run)
    long = docs.select(text_col).where(_has_run(F.coalesce(F.col(text_col), F.lit(""))))
    limits = control(docs, text_col, candidate_counts(with_findings(long, text_col, base, cands, found, run), cands), fdr)
    marked = with_findings(docs, text_col, base, cands, found, run).withColumn(spans, F.array_sort(F.concat(F.col(base), added(F.col(cands), limits))))
    t = F.col(text_col)
    return marked.withColumn(text_col, F.when(F.size(spans) > 0, _outside(t, F.col(spans), lambda _: F.lit(mark))).otherwise(t)).select(*docs.columns)


def _written(spans: str) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"), _written("spans").alias("spans"))
