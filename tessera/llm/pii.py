"""Personal data in texts, by rules and by labelers whose reliabilities are estimated.

Four base patterns with their checks find e-mail addresses, network addresses, card and phone numbers. Looser
patterns propose more candidates. Labelers vote on every candidate, for, against or not at all: the rule
(pattern and check), a gazetteer (endings, prefixes, issuers), the context, the borders and the
shape. Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is for each kind, without any labels; a logistic classifier of a span's votes is trained on the posteriors. Base spans
always stay; a candidate beyond them is added where the classifier is sure.

All work on texts is column expressions. What comes to the driver are the counts of vote patterns, at most
3 ** labelers for each kind however large the input, and weights go back as literals.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import computed_once
from tessera.llm.common import text_or_empty, written

#: Kinds in the order in which equal starts are listed.
KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "gazetteer", "context", "border", "shape")
SURE = 0.9

# The patterns find what the plain ones in the comments find. Runs are possessive where what follows can't start inside them, and
# start only at their first character, so long runs cost no retries.
_NAME = "[A-Za-z0-9._%+-]"
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 12 digits or more; the check needs as many
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){11,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]++ ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[] ?dot ?[)\]]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])",
}
#: A character without which a pattern finds nothing.
_NEEDS = {"email": "@", "phone": "+"}
_LOOSE_NEEDS = {"email": "at", "ip": ":", "phone": "-"}

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Word lists: names of kinds of data in the corpora's languages, and of what only looks like them.
CUES = {
    "email": r"e-?mail|mail|contact|write|kontakt|courriel|correo|adresse",
    "ip": r"\bip\b|host|server|login|address|adresse|servidor|serveur",
    "card": r"card|visa|credit|payment|karte|carte|tarjeta|iban|konto",
    "phone": r"phone|call|tel\b|tel[.:]|mobile|fax|telefon|t[eé]l[eé]phone|llam",
}
AGAINST = r"version|order|invoice|serial|isbn|token|hash|build|ticket|nummer|num[eé]ro|\bid\b|\bno\."
_ENDINGS = r"(?i)[.\])\x20](com|org|net|edu|gov|info|io|de|fr|es|uk|eu|ch|at|it|mx|ar)$"
CONTEXT = 40


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _block(items: Column) -> Column:
    """Length of the blocks that an array is gone through by: appending to them costs about as much as to the list of them."""
    return F.greatest(F.lit(32), F.ceil(F.sqrt(F.size(items))).cast("int"))


def scanned(items: Column, state: Column, state_type: str, out_type: str, step: Callable[[Column, Column], Column]) -> Column:
    """Go through an array from left to right: struct(state at the end, outs: all that ``step`` gave out on the way).

    ``step`` takes the state and an item and gives struct(state, outs: array). Results are gathered in blocks, as appending copies what is
    there already. ``items`` has to be a column, not an expression, which would be computed anew for each block.
    """
    kind = f"struct<state:{state_type},outs:array<{out_type}>>"
    nothing = F.array().cast(f"array<{out_type}>")

    def one(done: Column, item: Column) -> Column:
        return _let(
            step(done["state"], item),
            lambda r: F.struct(r["state"].alias("state"), F.concat(done["outs"], r["outs"]).alias("outs")).cast(kind),
        )

    def block(done: Column, at: Column) -> Column:
        part = F.slice(items, at, _block(items))
        return _let(
            F.aggregate(part, F.struct(done["state"].alias("state"), nothing.alias("outs")).cast(kind), one),
            lambda r: F.struct(r["state"].alias("state"), F.array_append(done["outs"], r["outs"]).alias("outs")),
        )

    start = F.struct(state.cast(state_type).alias("state"), F.array().cast(f"array<array<{out_type}>>").alias("outs"))
    places = F.sequence(F.lit(1), F.size(items), _block(items))
    done = F.aggregate(places, start, block, lambda r: F.struct(r["state"].alias("state"), F.flatten(r["outs"]).alias("outs")))
    empty = F.struct(state.cast(state_type).alias("state"), nothing.alias("outs"))
    return F.when(F.size(items) > 0, done).otherwise(empty)


#: A match: where it is, what it says, the text before it as far as the context goes, and the character after it.
_MATCH = "struct<start:int,end:int,found:string,before:string,after:string>"


def _parts(text: Column, pattern: str, needs: Column) -> Column:
    """Matches of a pattern, left to right, each with the text between the one before and it."""
    none = F.array().cast("array<string>")
    matches = F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    gaps = F.when(needs, F.split(text, pattern, -1)).otherwise(none)
    return F.struct(matches.alias("found"), gaps.alias("gap"))


def _placed(parts: Column) -> Column:
    """Parts as array of ``_MATCH``, in code points. The text itself is not looked at again: its places are far from its start."""
    number = F.sequence(F.lit(0), F.size(parts["found"]) - 1)

    def step(state: Column, i: Column) -> Column:
        gap, found = parts["gap"][i], parts["found"][i]
        start = state["at"] + F.length(gap)
        end = start + F.length(found)
        near = F.concat(state["tail"], F.right(gap, F.lit(CONTEXT)))
        before = F.right(near, F.lit(CONTEXT))
        following = F.coalesce(parts["gap"][i + 1], F.lit(""))
        after = F.left(F.when(following != "", following).otherwise(F.coalesce(F.get(parts["found"], i + 1), F.lit(""))), F.lit(1))
        values = zip(("start", "end", "found", "before", "after"), (start, end, found, before, after), strict=True)
        span = F.struct(*[v.alias(n) for n, v in values])
        tail = F.right(F.concat(before, F.right(found, F.lit(CONTEXT))), F.lit(CONTEXT))
        return F.struct(F.struct(end.alias("at"), tail.alias("tail")).alias("state"), F.array(span).alias("outs"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
    some = scanned(number, start, "struct<at:int,tail:string>", _MATCH, step)["outs"]
    return F.when(F.size(parts["found"]) > 0, some).otherwise(F.array().cast(f"array<{_MATCH}>"))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid(kind: str, found: Column) -> Column:
    """The base check of a match of the base pattern."""
    digits = _digits(found)
    if kind == "ip":
        return found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, span: Column, base: bool) -> list[Column]:
    """A vote of each labeler, in their order."""
    found, digits = span["found"], _digits(span["found"])
    before, last, following = F.lower(span["before"]), F.right(span["before"], F.lit(1)), span["after"]
    rule = _vote(_valid(kind, found), F.lit(True)) if base or kind == "card" else F.lit(0)
    if kind == "email":
        gazetteer = _vote(found.rlike(_ENDINGS), F.lit(False))
        shape = _vote(F.length(found).between(6, 80), F.lit(True))
    elif kind == "ip":
        gazetteer = _vote(F.lit(False), found.rlike(r"^(?:0|255|127)\."))
        shape = _vote(found.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})$|:"), F.lit(True))
    elif kind == "card":
        gazetteer = _vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"), F.lit(True))
        shape = _vote(F.length(digits).isin(15, 16), F.lit(True))
    else:
        gazetteer = _vote(found.rlike(r"^\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-8])"), F.lit(False))
        shape = _vote(F.length(digits).between(10, 13), F.lit(True))
    context = _vote(before.rlike(CUES[kind]), before.rlike(AGAINST))
    word = "[A-Za-z0-9_]"
    border = _vote(~last.rlike(word) & ~following.rlike(word), F.lit(True))
    return [rule, gazetteer, context, border, shape]


def candidates(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Add ``spans``: array of struct(start, end, kind, base, votes), base spans and other candidates."""
    kept = [F.col(f"`{c}`") for c in keep]
    body = docs.select(*kept, text_or_empty(f"`{text}`").alias("body"))
    digit = F.col("body").rlike("[0-9]")
    columns = []
    for kind in KINDS:
        needs = F.contains("body", F.lit(_NEEDS[kind])) if kind in _NEEDS else digit
        columns.append(_parts(F.col("body"), BASE[kind], needs).alias(f"base_{kind}"))
        loose = F.contains("body", F.lit(_LOOSE_NEEDS[kind])) if kind in _LOOSE_NEEDS else digit
        columns.append(_parts(F.col("body"), LOOSE[kind], loose & digit if kind != "email" else loose).alias(f"loose_{kind}"))
    raw = computed_once(body.select(*kept, F.struct(*columns).alias("raw")), "raw")
    names = [f"{part}_{kind}" for kind in KINDS for part in ("base", "loose")]
    placed = raw.select(*kept, F.struct(*[_placed(F.col(f"raw.{n}")).alias(n) for n in names]).alias("raw"))
    placed = computed_once(placed, "raw")

    def labelled(kind: str, base: bool) -> Column:
        def one(span: Column) -> Column:
            votes = F.array(*_votes(kind, span, base))
            valid = _valid(kind, span["found"]) if base else F.lit(False)
            return F.struct(
                span["start"].alias("start"), span["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"), valid.alias("base"), votes.alias("votes")
            )

        return F.transform(F.col(f"raw.{'base' if base else 'loose'}_{kind}"), one)

    spans = F.concat(*[labelled(kind, base) for kind in KINDS for base in (True, False)])
    return placed.select(*kept, spans.alias("spans"))


@dataclass
class LabelModel:
    """Reliabilities of the labelers for one kind of data, from the counts of their vote patterns."""

    prior: float
    given: list[tuple[dict[int, float], dict[int, float]]]

    @classmethod
    def estimate(cls, counts: dict[tuple[int, ...], int], rounds: int = 60) -> LabelModel:
        """Expectation-maximisation from the votes' majority; pseudo-counts lean to labelers being right."""
        share = {v: min(0.95, max(0.05, 0.5 + 0.15 * sum(v))) for v in counts}
        model = cls(0.5, [])
        for _ in range(rounds):
            yes = sum(n * share[v] for v, n in counts.items()) + 1
            no = sum(n * (1 - share[v]) for v, n in counts.items()) + 1
            given = []
            for i in range(len(LABELERS)):
                tallies = ({1: 2.0, 0: 1.0, -1: 0.5}, {1: 0.5, 0: 1.0, -1: 2.0})
                for v, n in counts.items():
                    tallies[0][v[i]] += n * share[v]
                    tallies[1][v[i]] += n * (1 - share[v])
                given.append(tuple({k: x / sum(t.values()) for k, x in t.items()} for t in tallies))
            model = cls(yes / (yes + no), given)
            share = {v: model.posterior(v) for v in counts}
        return model

    def posterior(self, votes: tuple[int, ...]) -> float:
        odds = math.log(self.prior / (1 - self.prior))
        odds += sum(math.log(yes[v] / no[v]) for v, (yes, no) in zip(votes, self.given, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _features(votes: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(v > 0) for v in votes), *(float(v < 0) for v in votes)]


def trained(counts: dict[tuple[int, ...], int], rounds: int = 400) -> list[float]:
    """Weights of the span classifier: logistic regression on the label model's posteriors, a weight per pattern."""
    if not counts:
        return [-10.0] + [0.0] * (2 * len(LABELERS))
    model, total = LabelModel.estimate(counts), sum(counts.values())
    rows = [(_features(v), n / total, model.posterior(v)) for v, n in sorted(counts.items())]
    weights = [0.0] * (1 + 2 * len(LABELERS))
    for _ in range(rounds):
        slope = [0.001 * w for w in weights]
        for x, n, goal in rows:
            z = sum(w * f for w, f in zip(weights, x, strict=True))
            off = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - goal)
            slope = [s + off * f for s, f in zip(slope, x, strict=True)]
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def span_classifiers(found: DataFrame) -> list[list[float]]:
    """The weights of each kind's classifier, from rows with ``spans``."""
    votes = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n"))
    counts: list[dict[tuple[int, ...], int]] = [{} for _ in KINDS]
    for row in votes.collect():  # at most 3 ** len(LABELERS) patterns of each kind
        counts[row["kind"]][tuple(row["votes"])] = row["n"]
    return [trained(c) for c in counts]


_SPAN = "struct<start:int,other:boolean,kind:int,end:int>"


def _with_chosen(rows: DataFrame, weights: list[list[float]], sure: float) -> DataFrame:
    """Add ``chosen``: base spans, and surer candidates that overlap none of them or of an earlier one: sorted (start, kind, end)."""
    limit = math.log(sure / (1 - sure))
    every = F.array(*[F.array(*map(F.lit, w)) for w in weights])

    def score(span: Column) -> Column:
        w = every[span["kind"]]
        total = w[0]
        for i in range(len(LABELERS)):
            vote = span["votes"][i]
            total = total + F.when(vote > 0, w[1 + i]).when(vote < 0, w[1 + len(LABELERS) + i]).otherwise(0.0)
        return total

    def plain(span: Column) -> Column:
        values = zip(("start", "other", "kind", "end"), (span["start"], ~span["base"], span["kind"], span["end"]), strict=True)
        return F.struct(*[v.alias(n) for n, v in values])

    sorted_spans = F.array_sort(F.transform(F.filter("spans", lambda s: s["base"] | (score(s) >= limit)), plain))
    rows = computed_once(rows.withColumn("chosen", sorted_spans), "chosen")

    def nearest(state: Column, span: Column) -> Column:
        """From the right: where the next base span starts."""
        fits = ~span["other"] | (span["end"] <= state)
        kept = F.when(fits, F.array(span)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        return F.struct(F.when(span["other"], state).otherwise(span["start"]).alias("state"), kept.alias("outs"))

    def first(state: Column, span: Column) -> Column:
        """From the left: up to where what is taken already reaches."""
        fits = ~span["other"] | (span["start"] >= state)
        kept = F.when(fits, F.array(span)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        return F.struct(F.when(fits, F.greatest(state, span["end"])).otherwise(state).alias("state"), kept.alias("outs"))

    others = F.exists("chosen", lambda s: s["other"])
    rows = rows.withColumn("chosen", F.when(others, F.reverse("chosen")).otherwise(F.col("chosen")))
    rows = computed_once(rows.withColumn("others", others), "chosen", "others")
    clear = scanned(F.col("chosen"), F.lit(2**31 - 1), "int", _SPAN, nearest)["outs"]
    rows = computed_once(rows.withColumn("chosen", F.when(F.col("others"), F.reverse(clear)).otherwise(F.col("chosen"))), "chosen")
    taken = scanned(F.col("chosen"), F.lit(0), "int", _SPAN, first)["outs"]
    ends = F.when(F.col("others"), taken).otherwise(F.col("chosen"))

    def listed(span: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"))

    return computed_once(rows.withColumn("chosen", F.array_sort(F.transform(ends, listed))).drop("others"), "chosen")


def _base_of(kind: int):
    return lambda span: span["base"] & (span["kind"] == kind)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base (listed), spans (listed).

    Counts and ``base`` cover the base spans, ``spans`` the added ones as well, as kind:start:end in code points, end
    exclusive, by start and then by kind. Null and empty texts have none and give empty lists. Every row gives a row, whatever its
    doc_id. No documents give no rows.
    """
    found = written(candidates(docs.select("doc_id", "text"), ["doc_id"]).select("doc_id", "spans"), "pii-candidates")
    chosen = _with_chosen(found, span_classifiers(found.filter(F.size("spans") > 0)), sure)
    base = F.array_sort(
        F.transform(
            F.filter("spans", lambda s: s["base"]),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    counts = [F.size(F.filter("spans", _base_of(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return chosen.select("doc_id", *counts, _listed(base).alias("base"), _listed(F.col("chosen")).alias("spans"))


def masked(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """The documents with each span replaced by its kind, as ``<EMAIL>``; overlapping spans become one.

    All columns and rows stay, repeated rows and rows without an id too; a null text becomes empty.
    """
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text"))
    found = written(candidates(row, ["row"]), "pii-spans")  # once for the classifiers and once for the masks
    rows = _with_chosen(found, span_classifiers(found.filter(F.size("spans") > 0)), sure)
    tags = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    piece = "struct<before:int,start:int,kind:int>"

    def cut(state: Column, span: Column) -> Column:
        """What is left of the text up to a span that does not overlap the one before."""
        fresh = F.struct(state.alias("before"), span["start"].alias("start"), span["kind"].alias("kind"))
        outs = F.when(span["start"] >= state, F.array(fresh)).otherwise(F.array().cast(f"array<{piece}>"))
        return F.struct(F.greatest(state, span["end"]).alias("state"), outs.alias("outs"))

    rows = rows.select("row", text_or_empty("row.text").alias("body"), scanned(F.col("chosen"), F.lit(0), "int", piece, cut).alias("cut"))
    rows = computed_once(rows.select("row", "body", F.col("cut.state").alias("at"), F.col("cut.outs").alias("pieces")), "at", "pieces")

    def replaced(block: Column) -> Column:
        """A block of pieces: their stretch is taken from the text once, they from it."""
        base, stop = block[0]["before"], F.element_at(block, -1)["start"]

        def one(text: Column) -> Column:
            parts = F.transform(
                block, lambda p: F.concat(F.substring(text, p["before"] - base + 1, p["start"] - p["before"]), tags[p["kind"]])
            )
            return F.array_join(parts, "")

        return _let(F.substring(F.col("body"), base + 1, stop - base), one)

    blocks = F.transform(
        F.sequence(F.lit(1), F.size("pieces"), _block(F.col("pieces"))),
        lambda i: _let(F.slice("pieces", i, _block(F.col("pieces"))), replaced),
    )
    rest = F.substring(F.col("body"), F.col("at") + 1, F.length("body"))
    text = F.when(F.size("pieces") == 0, F.col("body")).otherwise(F.concat(F.array_join(blocks, ""), rest))
    done = rows.select("row", text.alias("masked_text"))
    return done.select(*[F.col("masked_text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names])
