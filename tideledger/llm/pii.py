"""Personal data by weak supervision: three labelers vote on candidate spans, EM weighs them, a classifier decides.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideledger.llm.common import texts, written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive forms, and starts only where a run begins or the last match ended, give the
#: matches of the plain greedy patterns without retries inside long runs.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Written otherwise: only the votes can make these personal data.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?|\.)[A-Za-z]{2,24}",
    "phone": r"(?=[(0-9])(?<![0-9A-Za-z+)])(?<!\+[0-9]{1,3}[ .-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: What a text must hold for a pattern to match at all: most texts are read for these alone.
NEEDED = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]",
    "phone": r"\+[0-9]",
    "loose email": r"[\[(]at[\])]",
    "loose phone": r"[0-9]{3}[ .-][0-9]{4}",
}
#: Gazetteers: endings of mail domains, networks that name no host, card issuers' first digits, country calling codes.
KNOWN = {
    "email": r"(?i)[.)\]] ?(com|org|net|edu|gov|info|io|eu|de|fr|es|uk|it|nl)$",
    "ip": r"^0*([1-9]|[1-9][0-9]|1[013-9][0-9]|12[0-689]|2[01][0-9]|22[0-3])[.]",
    "card": "^[3-6]",
    "phone": r"^[+](1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
}
#: Words shortly before a span that speak for its kind, and what speaks against any.
NEAR = {
    "email": r"(?i)(mail|contact|write|reach|from|to:)\W?.{0,25}$",
    "ip": r"(?i)(\bip|address|host|server|login|client|from)\W?.{0,25}$",
    "card": r"(?i)(card|visa|pay|account|credit|debit)\W?.{0,25}$",
    "phone": r"(?i)(phone|\btel|call|fax|mobile|whatsapp|reach)\W?.{0,25}$",
}
AGAINST = r'(?i)(version|release|isbn|order|invoice|token|hash|commit|build|serial|[=#$/_])[ :]*"?$'
#: EM rounds over at most 27 vote patterns.
ROUNDS = 20
#: By labeler (pattern, gazetteer, context): right votes beforehand, as a share of all spans.
TRUST = (1.0, 0.1, 0.1)
#: Matches of a document that are worked on together.
RUN = 128
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_PLACED = "array<struct<start:int,m:string,digits:string,left:string,next:string>>"


def _runs(items: Column) -> Column:
    """An array cut into arrays of up to ``RUN`` neighbours."""
    begins = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(RUN)))
    return F.transform(begins, lambda i: F.slice(items, i, F.lit(RUN)))


def _placed(parts: Column, between: Column) -> Column:
    """Matches with their start, digits, and the characters around them, from the text between the matches.

    Starts are summed run by run, so that the array that grows by one is never longer than a run.
    """
    zipped = F.transform(parts, lambda m, i: F.struct(m.alias("m"), between[i].alias("b"), between[i + 1].alias("a")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_PLACED).alias("spans"))

    def step(done: Column, x: Column) -> Column:
        at = done["at"] + F.char_length(x["b"])
        span = F.struct(
            at.alias("start"),
            x["m"].alias("m"),
            F.regexp_replace(x["m"], "[^0-9]", "").alias("digits"),
            F.right(x["b"], F.lit(40)).alias("left"),
            F.left(x["a"], F.lit(1)).alias("next"),
        )
        return F.struct((at + F.char_length(x["m"])).alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def whole_run(done: Column, run: Column) -> Column:
        empty = F.struct(done["at"].alias("at"), F.array().cast(_PLACED).alias("spans"))
        more = F.aggregate(run, empty, step)
        return F.struct(more["at"].alias("at"), F.concat(done["spans"], more["spans"]).alias("spans"))

    return F.coalesce(F.aggregate(_runs(zipped), start, whole_run, lambda done: done["spans"]), F.array().cast(_PLACED))


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = (size - i) % 2 == 1
        return total + F.when(doubled, 2 * digit - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    size = F.length(span["digits"])
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return span["m"].rlike(f"^(?:{_PART}[.]){{3}}{_PART}$")
    if kind == "card":
        return F.when(size <= 19, _luhn(span["digits"])).otherwise(F.lit(False))
    return size.between(9, 15)


def _edge(letter: Column) -> Column:
    return F.when(letter.rlike(r"^\s?$"), "none").when(letter.rlike("[A-Za-z0-9]"), "word").otherwise("sign")


def _voted(kind: str, loose: bool):
    """A placed match as a candidate: its span, whether it is a base span, the labelers' votes (1, 0, -1) and features."""

    def candidate(span: Column) -> Column:
        valid = F.lit(False) if loose else _valid(kind, span)
        pattern = F.lit(0) if loose else F.when(valid, 1).otherwise(-1)
        gazetteer = F.when(span["m"].rlike(KNOWN[kind]), 1).otherwise(0 if loose else -1)
        context = F.when(span["left"].rlike(NEAR[kind]), 1).when(span["left"].rlike(AGAINST), -1).otherwise(0)
        size = F.least(F.floor(F.char_length(span["m"]) / 4), F.lit(12))
        features = F.array(
            F.lit(f"{'loose' if loose else 'base'} {kind}"),
            F.concat(F.lit("size "), size.cast("string")),
            F.concat(F.lit("before "), _edge(F.right(span["left"], F.lit(1)))),
            F.concat(F.lit("after "), _edge(span["next"])),
            F.concat(F.lit("pattern "), pattern.cast("string")),
            F.concat(F.lit("gazetteer "), gazetteer.cast("string")),
            F.concat(F.lit("context "), context.cast("string")),
        )
        return F.struct(
            span["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            (span["start"] + F.char_length(span["m"])).alias("end"),
            valid.alias("base"),
            F.array(pattern, gazetteer, context).alias("votes"),
            features.alias("features"),
        )

    return candidate


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: base spans and candidates that overlap none, of every row, by start, kind and end."""
    plans = [(kind, BASE[kind], False) for kind in KINDS] + [(kind, LOOSE[kind], True) for kind in LOOSE]
    text = F.col("text")

    def split_up(kind: str, pattern: str, loose: bool) -> Column:
        held = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("b"))
        return F.when(text.rlike(NEEDED["loose " * loose + kind]), held)

    rows = texts(docs).select("doc_id", *(split_up(*plan).alias(f"s{n}") for n, plan in enumerate(plans)))
    placed = rows.select("doc_id", *(_placed(F.col(f"s{n}.m"), F.col(f"s{n}.b")).alias(f"p{n}") for n in range(len(plans))))
    voted = [F.transform(f"p{n}", _voted(kind, loose)) for n, (kind, _, loose) in enumerate(plans)]
    spans = placed.select("doc_id", F.sort_array(F.concat(*voted)).alias("all"))
    # base spans by runs, each with its first start and last end: a candidate is compared with the runs that it touches
    own = _runs(F.filter("all", lambda x: x["base"]))
    runs = F.transform(own, lambda run: F.struct(run[0]["start"].alias("start"), F.array_max(run["end"]).alias("end"), run.alias("run")))
    spans = spans.withColumn("own", F.coalesce(runs, F.array()))

    def touches(y: Column, x: Column) -> Column:
        return (y["start"] < x["end"]) & (x["start"] < y["end"])

    def clear(x: Column) -> Column:
        return x["base"] | ~F.exists("own", lambda z: touches(z, x) & F.exists(z["run"], lambda y: touches(y, x)))

    return spans.select("doc_id", F.filter("all", clear).alias("spans"))


def reliabilities(found: DataFrame) -> DataFrame:
    """One row: ``truth``, a map from the labelers' votes to the probability that such a span is personal data.

    Dawid-Skene EM: the class prior and each labeler's votes given the class are re-estimated ``ROUNDS`` times from the counts
    of vote patterns, of which there are at most 27. Every labeler is taken to be right more often than wrong: spans that
    nobody has seen, as many as ``TRUST`` times those there are, count as right votes beforehand, most for the pattern labeler,
    which checks digits and ranges.
    """
    counts = found.select(F.explode("spans.votes").alias("v")).groupBy("v").agg(F.count("*").cast("double").alias("n"))
    first = (2 * F.col("v")[0] + F.col("v")[1] + F.col("v")[2]) / 10 + 0.5
    table = counts.agg(F.sort_array(F.collect_list(F.struct("v", "n", first.alias("p")))).alias("seen"))

    def total(seen: Column, weigh) -> Column:
        return F.aggregate(seen, F.lit(0.0), lambda done, y: done + weigh(y))

    def likelihood(seen: Column, x: Column, share, right: int) -> Column:
        every, all_spans = total(seen, share), total(seen, lambda y: y["n"])
        product = every + 1
        for k in range(3):
            same = total(seen, lambda y, k=k: F.when(y["v"][k] == x["v"][k], share(y)).otherwise(0.0))
            trust = F.when(x["v"][k] == right, all_spans * TRUST[k]).otherwise(0.0)
            product = product * (same + trust + 0.5) / (every + all_spans * TRUST[k] + 1.5)
        return product

    def again(seen: Column, _: Column) -> Column:
        def pattern(x: Column) -> Column:
            yes = likelihood(seen, x, lambda y: y["n"] * y["p"], 1)
            no = likelihood(seen, x, lambda y: y["n"] * (1 - y["p"]), -1)
            return F.struct(x["v"].alias("v"), x["n"].alias("n"), (yes / (yes + no)).alias("p"))

        return F.transform(seen, pattern)

    ended = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.col("seen"), again)
    return table.select(F.map_from_entries(F.transform(ended, lambda x: F.struct(x["v"], x["p"]))).alias("truth"))


def classifier(found: DataFrame) -> DataFrame:
    """One row: ``weights``, a map from a feature to its log odds, trained on the labelers' probabilities.

    Naive Bayes; the prior has the empty name. There are as many entries as features, a few dozen.
    """
    truth = F.col("truth")[F.col("span.votes")]
    labelled = found.select(F.explode("spans").alias("span")).withColumn("truth", reliabilities(found).scalar())
    labelled = labelled.select(truth.alias("p"), F.explode(F.concat(F.array(F.lit("")), F.col("span.features"))).alias("name"))
    sums = labelled.groupBy("name").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    odds = F.log((F.col("yes") + 1) / (F.col("no") + 1))
    entries = sums.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", odds)))).alias("raw"))
    # a feature's log odds are taken against the prior
    return entries.select(
        F.transform_values("raw", lambda name, w: F.when(name == "", w).otherwise(w - F.col("raw")[""])).alias("weights")
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row of ``docs`` (``doc_id``, ``text``, any others).

    A span has ``start``, ``end`` (code points, exclusive), ``kind`` (its place in ``KINDS``), ``base``. Base spans are the
    matches of the fixed patterns that pass their checks; they always stay. Others, matches that fail and looser spellings,
    are added if the classifier finds them likelier than not and no base span overlaps them.
    Null and empty texts have no spans; repeated rows and null ids stay; no rows give none.

    One pass over the texts; its spans are written, and what is learnt from all of them is a map of a few dozen entries.
    A document's spans are held together, as its text is.
    """
    found = written(candidates(docs), "pii")
    rows = found.withColumn("weights", classifier(found).scalar())
    weights = F.col("weights")

    def likely(x: Column) -> Column:
        start = F.coalesce(weights[""], F.lit(0.0))
        return F.aggregate(x["features"], start, lambda total, name: total + F.coalesce(weights[name], F.lit(0.0))) > 0

    spans = F.filter("spans", lambda x: x["base"] | likely(x))
    return rows.select(
        "doc_id",
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["base"].alias("base"))).alias("spans"),
    )


def _of_kind(kind: int):
    return lambda x: x["base"] & (x["kind"] == kind)


def digests(found: DataFrame) -> DataFrame:
    """Counts and joined spans of ``personal_data``, one row per document."""
    names = F.array(*map(F.lit, KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))),
            ",",
        )

    base = F.filter("spans", lambda x: x["base"])
    counts = [
        F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)
    ]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
