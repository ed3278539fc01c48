"""Personal data by weak supervision, in DataFrame expressions only.

Candidates are the matches of a strict pattern per kind that pass its check, and matches
of looser forms elsewhere.  Four labelers vote on each: a strict pattern check, a
gazetteer of prefixes and endings, cue words in the context, and the form of the borders.
Expectation-maximisation estimates each labeler's reliability per kind from the counts of
vote patterns; the estimated truths train a logistic span classifier, which decides on the
looser candidates.  Strict matches always stay.

Texts are never moved: candidates are cut inside the row, and only counts of vote
patterns (a bounded number) leave it.  Work and memory are linear in a text, up to sorting its
spans: running sums and maxima go by blocks, and what a lambda uses again and again is
bound to a variable first, as a lambda evaluates anything else it names for every element.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize, query, table

KINDS = ["email", "ip", "card", "phone"]

# The strict patterns.  Possessive forms and the conditions on the start change no match: a run of
# the first character class either matches from its beginning (or from where the last
# match ended) or nowhere.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?:(?: ?[\[(](?i:dot)[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,5}",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# A cheap test that a text can match at all.
HINT = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){12}[0-9]",
    "phone": r"\+[0-9]",
    "loose email": r"[\[(](?i:at)[\])]",
    "loose card": r"(?:[0-9][\x20-]?){12}[0-9]",
    "loose phone": r"[0-9]{3}[\x20.-][0-9]{4}",
}
# Endings and prefixes of the gazetteer, and cue words of the context.
ENDINGS = "com|net|org|edu|gov|int|mil|info|biz|io|dev|app|me|de|fr|es|it|nl|be|at|ch|pt|pl|eu|uk|ie|us|ca|mx|br|ar|au|nz|in|jp|cn|kr|ru|za"
CALLING = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
ISSUERS = r"4|5[1-5]|2[2-7]|3[4-7]|6011|64|65|62"
CUES = {
    "email": r"e-?mail|mailto|contact|correo|courriel|kontakt|write to",
    "ip": r"\bip\b|address|host|server|client|addr",
    "card": r"card|visa|master|amex|karte|carte|tarjeta|payment|iban",
    "phone": r"phone|call|tel|fax|mobile|mobil|whatsapp|telefon|teléfono|téléphone",
}
DOUBTS = r"version|release|isbn|issn|order|invoice|sku|\bref\b|\bid\b|section|§"

_SPAN = "struct<kind:int,start:int,end:int,from:int,to:int,base:boolean,votes:array<int>,digits:int,marks:int>"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def scan_before(parts: Column, first: Column, step: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """For each entry the ``step`` (associative, with ``first`` as its neutral value) over all entries before it."""

    def combine(n: Column, x: Column) -> Column:
        return step(n, x)

    def running(some: Column, start: Column) -> Column:
        return F.aggregate(some, F.array(start), lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x))))

    def by_blocks(p: Column) -> Column:
        numbers = F.filter(F.sequence(F.lit(0), F.floor(F.size(p) / block).cast("int")), lambda b: b * block < F.size(p))
        return _bind(F.transform(numbers, lambda b: F.slice(p, b * block + 1, F.lit(block))), over)

    def over(blocks: Column) -> Column:
        whole = F.transform(blocks, lambda b: F.aggregate(b, first, combine))
        return _bind(
            running(whole, first),
            lambda starts: F.flatten(
                F.transform(blocks, lambda b, i: F.slice(running(b, F.element_at(starts, i + 1)), 1, F.size(b)))
            ),
        )

    return _bind(parts, by_blocks)


def sums_before(parts: Column) -> Column:
    """For each entry of an int array the sum of those before it."""
    return scan_before(parts, F.lit(0), lambda n, x: n + x)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    worth = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0)))
    return F.aggregate(worth, F.lit(0), lambda n, v: n + v) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    """The check of the strict pattern."""
    digits = _digits(found)
    if kind == "ip":
        byte = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return found.rlike(rf"^{byte}(?:\.{byte}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, 0 against, -1 no opinion; without ``no`` what isn't yes is against."""
    return F.when(yes, 1).when(F.lit(True) if no is None else no, 0).otherwise(-1)


def _strict_form(kind: str, found: Column) -> Column:
    pattern = STRICT[kind].replace(r"(?:\G|(?<![A-Za-z0-9._%+-]))", "").replace(r"(?:\G|(?<![0-9]))", "")
    return found.rlike(f"^(?:{pattern})$") & _valid(kind, found)


def _listed(kind: str, found: Column) -> tuple[Column, Column | None]:
    if kind == "email":
        return found.rlike(rf"(?i)[.)\] ](?:{ENDINGS})$"), None
    if kind == "ip":
        return found.rlike(r"^0*(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\."), None
    if kind == "card":
        return _digits(found).rlike(f"^(?:{ISSUERS})"), None
    return found.rlike(f"^{CALLING}"), found.startswith("+")


def _kind_spans(text: Column, kind: str, loose: bool) -> Column:
    """Array of candidates of one kind, with their votes, in order."""
    pattern, number = (LOOSE if loose else STRICT)[kind], KINDS.index(kind)
    def span(r: Column) -> Column:
        m, at, context = r["m"], r["at"], F.lower(F.right(r["gap"], F.lit(32)))
        valid = _valid(kind, m) if not loose else F.lit(False)
        votes = F.array(
            _vote(_strict_form(kind, m)),
            _vote(*_listed(kind, m)),
            _vote(context.rlike(CUES[kind]), context.rlike(DOUBTS)),
            _vote(~context.rlike(r"[\p{L}\p{N}_]$") & ~F.left(r["after"], F.lit(1)).rlike(r"[\p{L}\p{N}_]")),
        )
        return F.struct(
            F.lit(number).alias("kind"), at.alias("start"), (at + F.length(m)).alias("end"), r["byte"].alias("from"),
            (r["byte"] + F.octet_length(m)).alias("to"), valid.alias("base"),
            votes.alias("votes"), F.least(F.length(_digits(m)), F.lit(20)).alias("digits"),
            F.least(F.length(F.regexp_replace(m, r"[\p{L}\p{N}]", "")), F.lit(8)).alias("marks"),
        )

    def of_lists(both: Column) -> Column:
        found, gaps = both["found"], both["gaps"]
        # the list of gaps is one longer than that of matches
        before = F.slice(gaps, 1, F.size(found))

        def starts(measure: Callable[[Column], Column]) -> Column:
            sizes = F.zip_with(before, found, lambda g, m: measure(g) + measure(m))
            return F.zip_with(sums_before(sizes), before, lambda n, g: n + measure(g))

        rows = F.arrays_zip(
            found.alias("m"), starts(F.length).alias("at"), starts(F.octet_length).alias("byte"), before.alias("gap"),
            F.slice(gaps, 2, F.size(found)).alias("after"),
        )
        spans = F.transform(rows, span)
        return spans if loose else F.filter(spans, lambda s: s["base"])

    lists = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("found"), F.split(text, pattern, -1).alias("gaps")
    )
    spans = _bind(lists, of_lists)
    hint = HINT[f"loose {kind}" if loose else kind]
    return F.when(text.rlike(hint), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``candidates``: strict matches by kind and start, then looser ones clear of them.

    A null text counts as empty.  A column of that name is replaced.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    strict = F.concat(*[_kind_spans(whole, k, False) for k in KINDS])
    loose = F.concat(*[_kind_spans(whole, k, True) for k in LOOSE])
    names = [F.col(f"`{c}`") for c in docs.columns if c != "candidates"]
    cut = docs.select(*names, F.struct(strict.alias("strict"), loose.alias("loose")).alias("candidates"))
    s, o = F.col("candidates.strict"), F.col("candidates.loose")
    return cut.select(*names, F.when(F.size(o) > 0, F.concat(s, clear_of(o, s))).otherwise(s).alias("candidates"))


_LATE = 2**31 - 1


def clear_of(loose: Column, strict: Column) -> Column:
    """The loose spans that no strict span overlaps, in their order.

    Both are sorted together; the largest strict end before a loose span and the least strict start
    after it decide.
    """
    none = F.lit(None).cast(_SPAN)
    both = F.array_sort(
        F.concat(
            F.transform(strict, lambda x: F.struct(
                x["start"].alias("start"), F.lit(-1).alias("place"), x["end"].alias("end"), none.alias("span"))),
            F.transform(loose, lambda x, i: F.struct(
                x["start"].alias("start"), i.alias("place"), x["end"].alias("end"), x.alias("span"))),
        ),
        lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["place"] - y["place"]),
    )

    def among(all_: Column) -> Column:
        strict_ends = F.transform(all_, lambda x: F.when(x["place"] < 0, x["end"]).otherwise(0))
        strict_starts = F.transform(F.reverse(all_), lambda x: F.when(x["place"] < 0, x["start"]).otherwise(_LATE))
        rows = F.arrays_zip(
            all_.alias("x"), scan_before(strict_ends, F.lit(0), F.greatest).alias("reached"),
            F.reverse(scan_before(strict_starts, F.lit(_LATE), F.least)).alias("next"),
        )
        kept = F.filter(
            rows, lambda r: (r["x"]["place"] >= 0) & (r["reached"] <= r["x"]["start"]) & (r["next"] >= r["x"]["end"])
        )
        ordered = F.array_sort(kept, lambda a, b: a["x"]["place"] - b["x"]["place"])
        return F.transform(ordered, lambda r: r["x"]["span"])

    return _bind(both, among)


@dataclass
class Model:
    """Reliabilities per kind (prior, then the yes and no rates of each labeler in either class) and the classifier."""

    reliability: dict[int, dict]
    weights: list[float]
    intercept: float


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[dict, dict]:
    """Expectation-maximisation on vote patterns with counts.

    Votes are taken as independent given the truth.  Starts from the share of yes votes; one
    pseudo-count per outcome keeps every rate inside (0, 1).  Returns the parameters and the
    probability of each pattern to be true.
    """
    def share(votes):
        cast = [v for v in votes if v >= 0]
        return min(0.9, max(0.1, sum(cast) / len(cast))) if cast else 0.5

    true = {votes: share(votes) for votes, _ in patterns}
    labelers = range(len(patterns[0][0]))
    rates: dict = {}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = (1 + sum(n * true[v] for v, n in patterns)) / (2 + total)
        rates = {"prior": prior, "rate": {}}
        for side in (1, 0):
            for j in labelers:
                weights = {o: 1.0 for o in (-1, 0, 1)}
                for v, n in patterns:
                    weights[v[j]] += n * (true[v] if side else 1 - true[v])
                # a labeler is better than chance: its yes speaks for the span before any count
                weights[side] += 2.0
                for o in weights:
                    rates["rate"][side, j, o] = weights[o] / sum(weights.values())
        for v, _ in patterns:
            yes, no = prior, 1 - prior
            for j in labelers:
                yes *= rates["rate"][1, j, v[j]]
                no *= rates["rate"][0, j, v[j]]
            true[v] = yes / (yes + no)
    return rates, true


def _features(kind: Column, votes: Column, digits: Column, marks: Column) -> list[Column]:
    """Inputs of the classifier, each within [-1, 1]."""
    kinds = [(kind == k).cast("double") for k in range(len(KINDS))]
    votes = [F.when(F.element_at(votes, j + 1) < 0, 0.0).otherwise(F.element_at(votes, j + 1) * 2.0 - 1.0) for j in range(4)]
    return [*kinds, *votes, digits / 20.0, marks / 8.0]


def fit(found: DataFrame) -> Model | None:
    """Estimate the labelers and train the span classifier on all ``candidates``; None without any.

    Candidates are counted by kind, votes and shape where they are: at most some ten
    thousand combinations whatever the input.
    """
    spans = found.select(F.explode("candidates").alias("s")).select("s.kind", "s.votes", "s.digits", "s.marks")
    counts = spans.groupBy("kind", "votes", "digits", "marks").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    by_kind: dict[int, dict[tuple[int, ...], int]] = {}
    for r in counts:
        own = by_kind.setdefault(r["kind"], {})
        own[tuple(r["votes"])] = own.get(tuple(r["votes"]), 0) + r["n"]
    estimated = {k: reliabilities(sorted(p.items())) for k, p in by_kind.items()}
    rows = []
    for r in counts:
        p = estimated[r["kind"]][1][tuple(r["votes"])]
        rows += [(r["kind"], list(r["votes"]), r["digits"], r["marks"], y, r["n"] * w) for y, w in ((1.0, p), (0.0, 1 - p))]
    spark = found.sparkSession
    frame = spark.createDataFrame(rows, "kind int, votes array<int>, digits int, marks int, label double, weight double")
    names = [f"f{i}" for i in range(10)]
    inputs = _features(F.col("kind"), F.col("votes"), F.col("digits"), F.col("marks"))
    frame = frame.coalesce(1).select("label", "weight", *[c.alias(n) for c, n in zip(inputs, names)])
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(frame)
    classifier = LogisticRegression(weightCol="weight", regParam=1e-4, standardization=False, maxIter=60).fit(ready)
    return Model({k: e[0] for k, e in estimated.items()}, [float(w) for w in classifier.coefficients], float(classifier.intercept))


def spans(model: Model | None, found: str = "candidates") -> Column:
    """The accepted spans of ``candidates``: strict ones, and looser ones that the classifier takes."""
    def accepted(s: Column) -> Column:
        if model is None:
            return s["base"]
        score = F.lit(model.intercept)
        for w, x in zip(model.weights, _features(s["kind"], s["votes"], s["digits"], s["marks"])):
            score = score + F.lit(w) * x
        return s["base"] | (score >= 0)

    return F.filter(found, accepted)


def listing(some: Column) -> Column:
    """``kind:start:end`` by kind and start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(some, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with every accepted span of ``text`` replaced by its kind in brackets.

    Overlapping spans become one, named after the first.  Texts without spans, and nulls, stay.
    """
    return replace_spans(candidates(docs), model)


def replace_spans(found: DataFrame, model: Model | None) -> DataFrame:
    """What ``redact`` gives for documents with their ``candidates``; that column goes."""
    names = [c for c in found.columns if c != "candidates"]
    ordered = F.array_sort(
        F.transform(spans(model), lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to"), s["kind"].alias("kind")))
    )
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def clean(raw: Column) -> Column:
        return _bind(ordered, lambda some: _bind(_united(some), lambda u: put_together(raw, u)))

    def put_together(raw: Column, united: Column) -> Column:
        # what stands before each span begins where the one before it ended
        ends = F.concat(F.array(F.lit(0)), F.transform(united, lambda s: s["to"]))
        pieces = F.zip_with(
            F.slice(ends, 1, F.size(united)), united,
            lambda at, s: F.concat(F.substring(raw, at + 1, s["from"] - at).cast("string"), F.element_at(tags, s["kind"] + 1)),
        )
        tail = F.substring(raw, F.element_at(ends, -1) + 1, F.length(raw)).cast("string")
        return F.concat(F.array_join(pieces, ""), tail)

    # bytes are cut by place, characters would be counted from the beginning for every span
    text = F.when(F.size("candidates") > 0, _bind(F.col("text").cast("string").cast("binary"), clean)).otherwise(F.col("text"))
    return found.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in names])


def _united(some: Column) -> Column:
    """Sorted spans with overlapping ones made one of the first's kind."""
    rows = F.arrays_zip(
        some.alias("s"), scan_before(F.transform(some, lambda s: s["to"]), F.lit(0), F.greatest).alias("reached")
    )
    firsts = F.filter(rows, lambda r: r["s"]["from"] >= r["reached"])
    # a span's end is the largest before the next one that begins anew
    return _bind(
        firsts,
        lambda f: F.zip_with(
            f, F.concat(F.slice(F.transform(f, lambda r: r["reached"]), 2, F.size(f)), F.array(F.array_max(F.transform(some, lambda s: s["to"])))),
            lambda r, to: F.struct(r["s"]["from"].alias("from"), to.alias("to"), r["s"]["kind"].alias("kind")),
        ),
    )


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialize(candidates(docs).select("doc_id", "candidates"), "pii-candidates")
    model = fit(found)
    base = F.filter("candidates", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(len(KINDS))]
    return found.select(
        "doc_id", *counts, F.sha2(listing(base), 256).alias("base_sha256"), listing(spans(model)).alias("spans")
    )
