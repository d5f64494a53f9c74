"""Personal data: candidate spans scored by boosted trees.

Exact patterns give the base spans.  Wider generators propose overlapping candidates;
gradient-boosted trees, fitted on a bounded sample, see the format of a candidate and
the text around it.  Their labels are weak: a candidate counts as personal data when it
is a base span, or when a cue word of its kind stands before it and its digits or parts
can be valid.  For each kind a threshold is chosen over all candidates kept from the
fit, so that the precision there reaches a target; candidates above it that touch no
base span are added.  Everything is a column expression: the trees are written out as
one, so scoring needs neither a shuffle nor Python.  Places come from sums and extremes
taken by doubling, so a text costs n log n in its matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_SPANS = 20_000, 20_000
TREES, DEPTH, PRECISION = 12, 4, 0.98
CONTEXT = 24
# Code points of a block of text; a redacted text is put together from pieces of blocks.
BLOCK = 1024

# Maximal runs of the characters a match may consist of; no match crosses the end of one.
# Look-behinds and possessive quantifiers keep matching linear and free of recursion.
NUMBER_RUN = r"\+?[0-9][0-9 ().+-]*+"
MAIL_RUN = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*+@[A-Za-z0-9._%+@-]*+"

BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9._%+-]*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+",
    "card": r"[0-9](?:[ .-]{0,2}[0-9]){11,}+",
    "phone": r"\+?[0-9](?:[ ().-]{0,3}[0-9]){6,}+",
}
LUHN = (
    "aggregate(sequence(1, length(c.digits)), 0, (t, d) -> t + "
    "CASE WHEN d % 2 = 1 THEN int(substr(c.digits, -d, 1)) WHEN int(substr(c.digits, -d, 1)) > 4 "
    "THEN 2 * int(substr(c.digits, -d, 1)) - 9 ELSE 2 * int(substr(c.digits, -d, 1)) END) % 10 = 0"
)
VALID = {
    "email": "c.m rlike '[A-Za-z0-9]@[A-Za-z0-9]'",
    "ip": r"size(split(c.m, r'\.')) = 4 AND forall(split(c.m, r'\.'), q -> coalesce(try_cast(q AS INT), 256) <= 255)",
    "card": f"length(c.digits) BETWEEN 12 AND 19 AND {LUHN}",
    "phone": "length(c.digits) BETWEEN 9 AND 15",
}
CUES = {
    "email": "mail|contact|write",
    "ip": "host|addr|server|from",
    "card": "card|visa|paid|account",
    "phone": "tel|phone|fax|call|mobile",
}


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _scan(values: str, step: str) -> str:
    """Running values of an array by doubling: ``step`` joins x with the one 2^k places off."""
    levels = "sequence(0, int(log2(greatest(size(vs), 1))))"
    return _let("vs", values, f"aggregate({levels}, vs, (acc, k) -> transform(acc, (x, i) -> {step}))")


def _sums(values: str) -> str:
    return _scan(values, "x + coalesce(get(acc, i - shiftleft(1, k)), 0)")


def _highest_so_far(values: str) -> str:
    return _scan(values, "greatest(x, get(acc, i - shiftleft(1, k)))")


def _lowest_from_here(values: str) -> str:
    return _scan(values, "least(x, get(acc, i + shiftleft(1, k)))")


def _matches(text: str, pattern: str, item: str) -> str:
    """An array with one ``item`` per match of ``pattern``: h is the match, es[j] its end.

    hs are all matches, ps the parts of the text around them: ps[j] stands before h.
    """
    ends = _sums("transform(hs, (h, j) -> length(get(ps, j)) + length(h))")
    found = _let("ps", f"split({text}, r'{pattern}', -1)", _let("es", ends, f"transform(hs, (h, j) -> {item})"))
    return _let("hs", f"regexp_extract_all({text}, r'{pattern}', 0)", found)


def _runs(pattern: str) -> str:
    return _matches("_text", pattern, (
        f"named_struct('at', get(es, j) - length(h), 'run', h, 'before', right(get(ps, j), {CONTEXT}), "
        "'after', left(get(ps, j + 1), 1))"
    ))


_PLACE = (
    "'start', r.at + get(es, j) - length(h), 'kind', {kind}, 'stop', r.at + get(es, j), 'm', h, "
    "'digits', regexp_replace(h, '[^0-9]', '')"
)


def _base(kind: str) -> str:
    item = f"named_struct({_PLACE.format(kind=KINDS.index(kind))})"
    valid = "true" if kind == "email" else VALID[kind]
    return f"filter({_matches('r.run', BASE[kind], item)}, c -> {valid})"


def _proposed(kind: str) -> str:
    # The text before reaches back to the match before, the text after up to the next one.
    item = (
        f"named_struct({_PLACE.format(kind=KINDS.index(kind))}, "
        f"'before', lower(right(concat(IF(j = 0, r.before, get(hs, j - 1)), get(ps, j)), {CONTEXT})), "
        "'after', IF(get(ps, j + 1) != '', left(get(ps, j + 1), 1), coalesce(left(get(hs, j + 1), 1), r.after)))"
    )
    return _matches("r.run", GENERATORS[kind], item)


def _by_kind(of: dict[str, str]) -> str:
    return "CASE c.kind " + " ".join(f"WHEN {k} THEN {of[kind]}" for k, kind in enumerate(KINDS)) + " END"


def _count(pattern: str) -> str:
    return f"double(length(c.m) - length(regexp_replace(c.m, '{pattern}', '')))"


# Features of a candidate c: its format, then the characters and words around it.
FEATURES = {
    "kind": "double(c.kind)",
    "length": "double(least(length(c.m), 64))",
    "digits": _count("[0-9]"),
    "letters": _count("[A-Za-z]"),
    "dots": _count("[.]"),
    "spaces": _count(" "),
    "dashes": _count("-"),
    "parens": _count("[()]"),
    "plus": _count("[+]"),
    "ats": _count("@"),
    "groups": "double(size(regexp_extract_all(c.m, '[0-9]+', 0)))",
    "longest": "double(coalesce(array_max(transform(regexp_extract_all(c.m, '[0-9]+', 0), g -> length(g))), 0))",
    "last": "double(length(regexp_extract(c.m, '([A-Za-z0-9-]*)$', 1)))",
    "joined_left": "double(c.before rlike '[a-z0-9.]$')",
    "joined_right": "double(c.after rlike '[A-Za-z0-9]')",
    "cue": f"double({_by_kind({kind: f"c.before rlike '{cue}'" for kind, cue in CUES.items()})})",
    "version": "double(c.before rlike 'version|licen|chapter|section')",
}

# Only the labels see whether a candidate can be valid; the trees must do without.
SEEN = tuple(FEATURES)
FEATURES["valid"] = f"double({_by_kind(VALID)})"


@dataclass(frozen=True)
class Scorer:
    """The fitted trees as one SQL expression of a feature struct f, and a threshold per kind."""

    margin: str
    thresholds: tuple[float | None, ...]


def with_candidates(rows: DataFrame) -> DataFrame:
    """Add _base, the exact spans, and _proposed, the candidates, to rows with _text.

    A candidate has its place, its features f, a hash of itself with its surroundings,
    its weak label, and tells whether it is a base span (base) or touches none (free).
    """
    base = (
        f"array_sort(concat(flatten(transform(_mails, r -> {_base('email')})), flatten(transform(_numbers, r -> "
        f"concat({_base('ip')}, {_base('card')}, {_base('phone')})))))"
    )
    proposed = (
        f"concat(flatten(transform(_mails, r -> {_proposed('email')})), flatten(transform(_numbers, r -> "
        f"concat({_proposed('ip')}, {_proposed('card')}, {_proposed('phone')}))))"
    )
    features = ", ".join(f"'{k}', {v}" for k, v in FEATURES.items())
    kind_of_f = f"struct<{', '.join(f'{k}:double' for k in FEATURES)}>"
    place = "'start', c.start, 'kind', c.kind, 'stop', c.stop"
    # In one order of places, a base span equal to a candidate stands right before it.
    merged = (
        f"array_sort(concat(transform(_base, c -> named_struct({place}, 'own', 0, 'hash', 0L, 'f', CAST(NULL AS {kind_of_f}))), "
        f"transform(_spans, c -> named_struct({place}, 'own', 1, 'hash', xxhash64(c.kind, c.m, c.before, c.after), "
        f"'f', named_struct({features})))))"
    )
    same = "coalesce(get(ms, n - 1).own = 0 AND get(ms, n - 1).start = c.start AND get(ms, n - 1).kind = c.kind AND get(ms, n - 1).stop = c.stop, false)"
    judged = (
        f"filter(transform(ms, (c, n) -> named_struct({place}, 'own', c.own, 'hash', c.hash, 'f', c.f, 'base', {same}, "
        f"'label', {same} OR (c.f.cue > 0 AND c.f.valid > 0), "
        "'free', get(reach, n) <= c.start AND get(ahead, n) >= c.stop)), c -> c.own = 1)"
    )
    reach = _highest_so_far("transform(ms, c -> IF(c.own = 0, c.stop, 0))")
    ahead = _lowest_from_here("transform(ms, c -> IF(c.own = 0, c.start, 2147483647))")
    found = rows.withColumns({"_mails": F.expr(_runs(MAIL_RUN)), "_numbers": F.expr(_runs(NUMBER_RUN))})
    found = found.withColumns({"_base": F.expr(base), "_spans": F.expr(proposed)})
    swept = _let("ms", merged, _let("reach", reach, _let("ahead", ahead, judged)))
    return found.withColumn("_proposed", F.expr(swept)).drop("_mails", "_numbers", "_spans")


def _written_out(node, names: list[str]) -> str:
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    left, right = _written_out(node.leftChild(), names), _written_out(node.rightChild(), names)
    return f"IF(f.{names[split.featureIndex()]} <= {float(split.threshold())!r}D, {left}, {right})".replace("inf", "1e308")


def fit_trees(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_spans: int = SAMPLE_SPANS) -> str | None:
    """The trees as SQL, fitted on candidates of about ``sample_docs`` different texts, chosen by their hash.

    At most ``sample_spans`` different candidates with an even hash are used, the
    smallest by hash, so copies of a text count once.  None without both labels.
    """
    share = max(1, docs.count() // sample_docs)
    texts = docs.select(text_of().alias("_text")).filter("_text rlike '[0-9@]'")
    picked = texts.filter(F.pmod(F.xxhash64("_text"), F.lit(share)) == 0).distinct()
    # Written first: else the planner asks for the candidates of every text before it samples.
    picked = materialize(picked, "sampled-texts")
    each = with_candidates(picked).select(F.explode("_proposed").alias("c")).filter("c.hash % 2 = 0 AND (c.base OR c.free)")
    spans = each.select("c.hash", "c.f.*", F.col("c.label").cast("double").alias("_label"))
    alike = spans.groupBy("hash").agg(*[F.max(n).alias(n) for n in (*SEEN, "_label")])
    sample = materialize(alike.orderBy("hash").limit(sample_spans), "candidates")
    if sample.select("_label").distinct().count() < 2:
        return None
    names = list(SEEN)
    vectors = VectorAssembler(inputCols=names, outputCol="_vector").transform(sample)
    model = GBTClassifier(
        featuresCol="_vector", labelCol="_label", maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False
    ).fit(vectors)
    return " + ".join(
        f"{weight!r}D * {_written_out(tree._call_java('rootNode'), names)}"
        for tree, weight in zip(model.trees, model.treeWeights)
    )


def with_scores(rows: DataFrame, margin: str | None) -> DataFrame:
    """Add _base and _scored, the candidates with the margin of the trees, to rows with _text."""
    scored = (
        "transform(_proposed, c -> named_struct('start', c.start, 'kind', c.kind, 'stop', c.stop, 'held', c.hash % 2 != 0, "
        f"'label', c.label, 'base', c.base, 'free', c.free, 'margin', floor(({(margin or '0.0D').replace('f.', 'c.f.')}) * 1000) / 1000D))"
    )
    return with_candidates(rows).withColumn("_scored", F.expr(scored)).drop("_proposed")


def thresholds_of(scored: DataFrame, precision: float = PRECISION) -> tuple[float | None, ...]:
    """Per kind the lowest margin with that precision over all candidates kept from the fit, None without one.

    A candidate that overlaps a base span without being one can never be added and does not count.
    """
    held = scored.select(F.explode("_scored").alias("c")).filter("c.held AND (c.base OR c.free)")
    # One row per kind and rounded margin: bounded by the leaves of the trees and the rounding.
    table = held.groupBy("c.kind", "c.margin").agg(F.sum(F.col("c.label").cast("bigint")).alias("hits"), F.count("*").alias("n"))
    rows = table.orderBy("kind", F.desc("margin")).collect()
    found = []
    for kind in range(len(KINDS)):
        best, hits, total = None, 0, 0
        for row in (r for r in rows if r["kind"] == kind):
            hits, total = hits + row["hits"], total + row["n"]
            if hits >= precision * total:
                best = row["margin"]
        found.append(best)
    return tuple(found)


def fit(
    docs: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    sample_spans: int = SAMPLE_SPANS,
    precision: float = PRECISION,
) -> Scorer:
    """Trees from a bounded sample, thresholds from all candidates of ``docs`` kept from the fit.

    Without both labels, or without a threshold of that precision, nothing is added to
    the base spans of a kind.
    """
    margin = fit_trees(docs, sample_docs, sample_spans)
    if margin is None:
        return Scorer("0.0D", (None,) * len(KINDS))
    return Scorer(margin, thresholds_of(with_scores(docs.select(text_of().alias("_text")), margin), precision))


def _scored_with(docs: DataFrame, rows: DataFrame, scorer: Scorer | None) -> tuple[DataFrame, Scorer]:
    """Scored ``rows`` and their scorer; one that is fitted here reads its thresholds from the written scores."""
    if scorer is not None:
        return with_scores(rows, scorer.margin), scorer
    margin = fit_trees(docs)
    if margin is None:
        return with_scores(rows, None), Scorer("0.0D", (None,) * len(KINDS))
    scored = with_scores(rows, margin)
    kept = materialize(scored.drop("_text") if "_doc" not in rows.columns else scored, "scored-candidates")
    return kept, Scorer(margin, thresholds_of(kept))


def with_spans(scored: DataFrame, scorer: Scorer) -> DataFrame:
    """Add _all to scored rows: an array of (start, kind, stop), by start and kind.

    It holds every base span and each candidate from its kind's threshold on that
    touches none.  Added spans of different kinds may overlap, as base spans may.
    """
    picks = " ".join(f"WHEN {k} THEN {t!r}D" for k, t in enumerate(scorer.thresholds) if t is not None)
    plain = "c -> named_struct('start', c.start, 'kind', c.kind, 'stop', c.stop)"
    if not picks:
        return scored.withColumn("_all", F.expr(f"transform(_base, {plain})")).drop("_scored")
    added = f"filter(_scored, c -> c.free AND coalesce(c.margin >= CASE c.kind {picks} END, false))"
    both = f"array_sort(concat(transform(_base, {plain}), transform({added}, {plain})))"
    return scored.withColumn("_all", F.expr(both)).drop("_scored")


NAME = f"element_at(array({', '.join(map(repr, KINDS))}), c.kind + 1)"


def _joined(column: str) -> str:
    return f"array_join(transform({column}, c -> concat_ws(':', {NAME}, string(c.start), string(c.stop))), ',')"


def find(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """doc_id, number of base spans of each kind, their digest, and all spans of every whole text.

    Places are code points, ends exclusive.  Null and empty texts have no spans; repeated
    rows give repeated results, an empty table none; columns other than doc_id and text
    are not looked at.  The time of a text grows with n log n of its matches.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("_text"))
    rows = with_spans(*_scored_with(docs, texts, scorer))
    counts = [
        F.expr(f"size(filter(_base, c -> c.kind = {k}))").cast("bigint").alias(f"n_{kind}") for k, kind in enumerate(KINDS)
    ]
    return rows.select(
        "doc_id", *counts, F.sha2(F.expr(_joined("_base")), 256).alias("base_sha256"), F.expr(_joined("_all")).alias("spans")
    )


def _piece(a: str, b: str) -> str:
    """The text from code point a up to b, read from its blocks: no place is searched from the text's start."""
    first, last = f"({a}) div {BLOCK}", f"({b}) div {BLOCK}"
    return (
        f"IF({first} = {last}, coalesce(substr(get(blocks, int({first})), int(({a}) % {BLOCK} + 1), int(({b}) - ({a}))), ''), "
        f"concat(substr(get(blocks, int({first})), int(({a}) % {BLOCK} + 1)), "
        f"array_join(slice(blocks, int({first} + 2), int({last} - {first} - 1)), ''), "
        f"coalesce(left(get(blocks, int({last})), int(({b}) % {BLOCK})), '')))"
    )


def redact(docs: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; a null text stays null.

    Of spans that overlap, the first gives the kind and all are cut.  Repeated rows give
    repeated results, an empty table none; other columns stay, whatever their names.
    """
    whole = docs.select(F.struct("*").alias("_doc"), text_of().alias("_text"))
    rows = with_spans(*_scored_with(docs, whole, scorer))
    blocks = f"regexp_extract_all(_text, r'(?s).{{1,{BLOCK}}}+', 0)"
    reach = _highest_so_far("transform(cs, c -> c.stop)")
    before = "IF(n = 0, 0, get(reach, n - 1))"
    cut = f"transform(cs, (c, n) -> IF(c.start >= {before}, concat({_piece(before, 'c.start')}, '<', {NAME}, '>'), ''))"
    tail = _piece("array_max(reach)", "length(_text)")
    body = _let("blocks", blocks, _let("reach", reach, f"concat(array_join({cut}, ''), {tail})"))
    changed = F.expr(f"CASE WHEN _doc.text IS NULL THEN NULL WHEN size(_all) = 0 THEN _text ELSE {_let('cs', '_all', body)} END")
    return rows.select(*[changed.alias(c) if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns])
