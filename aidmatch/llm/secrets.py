"""Secrets in texts, with weak candidates confirmed by what stands near them; DataFrame operations only.

Patterns give strong findings: assignments to secret-like names, access
identifiers, long hexadecimal runs. Weak candidates (an account name, a bare
token, a short password, an endpoint) mean little alone. They are parts of one
credential when complementary parts lie within ``SCOPE`` code points: parts are
ordered by place, running extremes give the nearest part of each other sort
before and after, and a candidate is reported when its complement is near and no
strong finding covers it. That interval join takes one pass over the parts of a
text, no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aidmatch.llm.common import saved_with_row_id, whole_text

#: Most code points between complementary parts.
SCOPE = 400

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
#: kind, pattern, group that must be long enough, its length
BASE = [
    ("assign", r"((?:(?i:password|passwd|secret|token|api_?key)))" + _VALUE + r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
#: kind, part of a credential, pattern; names may follow a prefix that ends in "_", a token the "=" after a name
WEAK = [
    ("linked_id", "id", r"(?<![A-Za-z0-9])(?i:user(?:name)?|login|account|client_?id|key_?id)" + _VALUE + r"[A-Za-z0-9._@-]{3,}"),
    ("linked_secret", "secret", r"(?<![A-Za-z0-9])(?i:pass|pwd|password|passwd|secret)" + _VALUE + r"[A-Za-z0-9+/_.=!#$%&*-]{4,}"),
    ("linked_token", "secret", r"(?:(?<![A-Za-z0-9/+=])|(?<=[A-Za-z0-9_\x20\"'\]:]=))(?=[A-Za-z/+]{0,39}[0-9])(?=[a-z0-9/+]{0,39}[A-Z])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])"),
    ("linked_endpoint", "endpoint", r"(?:(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|ftp)://|(?<![A-Za-z0-9])(?i:host|endpoint|server)"
     + _VALUE + r")[A-Za-z0-9._-]+(?::[0-9]{1,5})?"),
]
#: Part of a credential that a strong finding is.
STRONG_PART = {"assign": "secret", "access": "id", "hex": "secret"}
#: For each part, the sorts of which one must be near.
COMPLEMENT = {"id": ["secret"], "secret": ["id", "endpoint"], "endpoint": ["secret"]}
ORDER = [kind for kind, *_ in BASE] + [kind for kind, *_ in WEAK]

_SPAN = "array<struct<low:bigint,high:bigint>>"
_BLOCK = 256


def spans_of(pattern: str, group: int = 0, least: int = 0) -> Column:
    """Places of all leftmost matches in ``text``, those with a short group left out, as ``(low, high)`` in code points.

    The text is split at the matches, so places are running sums of the lengths
    of pieces and matches. Sums run within blocks of 256 matches and then over
    the blocks, which keeps the work for n matches near n.
    """
    p = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    lengths = "zip_with(slice(s.pieces, 1, size(s.found)), s.found, (x, y) -> named_struct('gap', length(x), 'long', length(y)))"
    blocks = f"transform(sequence(0, (size(s.found) - 1) div {_BLOCK}), b -> slice({{}}, b * {_BLOCK} + 1, {_BLOCK}))"
    within = (
        f"aggregate(block, cast(array() as {_SPAN}), (sums, x) -> concat(sums, array(named_struct("
        "'low', coalesce(try_element_at(sums, -1).high, 0) + x.gap, 'high', coalesce(try_element_at(sums, -1).high, 0) + x.gap + x.long))))"
    )
    summed = f"transform(cut, block -> {within})"
    offsets = "aggregate(sums, array(0L), (past, block) -> concat(past, array(element_at(past, -1) + element_at(block, -1).high)))"
    moved = (
        f"flatten(zip_with(sums, slice({offsets}, 1, size(sums)), (block, past) -> "
        "transform(block, x -> named_struct('low', x.low + past, 'high', x.high + past))))"
    )
    # a lambda over one element names a value without computing it again
    place = f"transform(transform(array({blocks.format(lengths)}), cut -> {summed}), sums -> {moved})[0]"
    kept = (
        f"transform(filter(zip_with({place}, s.checked, (x, y) -> named_struct('span', x, 'checked', y)), "
        f"x -> length(x.checked) >= {least}), x -> x.span)"
    ) if least else place
    named = (
        f"array(named_struct('pieces', split(text, {p}, -1), 'found', regexp_extract_all(text, {p}, 0)"
        + (f", 'checked', regexp_extract_all(text, {p}, {group})" if least else "") + "))"
    )
    return F.expr(f"CASE WHEN text RLIKE {p} THEN transform({named}, s -> {kept})[0] ELSE cast(array() as {_SPAN}) END")


def _labelled(column: str, order: int) -> Column:
    return F.transform(column, lambda x: F.struct(x["low"].alias("low"), F.lit(order).alias("nth"), x["high"].alias("high")))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, ORDER))
    text = F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["nth"] + 1), x["low"].cast("string"), x["high"].cast("string")
    ))
    return F.array_join(text, ",")


def linked(parts: DataFrame) -> DataFrame:
    """The weak parts (row_id, part, weak, low, high, nth) that have a complement within the scope and lie in no strong finding."""
    back = Window.partitionBy("row_id").orderBy("low", "high", "nth").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("row_id").orderBy(F.desc("low"), F.desc("high"), F.desc("nth")).rowsBetween(Window.unboundedPreceding, -1)

    def near(sort: str) -> Column:
        before = F.max(F.when(F.col("part") == sort, F.col("high"))).over(back)
        after = F.min(F.when(F.col("part") == sort, F.col("low"))).over(ahead)
        return F.coalesce(F.col("low") - before <= SCOPE, F.lit(False)) | F.coalesce(after - F.col("high") <= SCOPE, F.lit(False))

    begun = Window.partitionBy("row_id").orderBy("low").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.coalesce(F.max(F.when(~F.col("weak"), F.col("high"))).over(begun) >= F.col("high"), F.lit(False))
    marked = parts.withColumns({f"near_{sort}": near(sort) for sort in COMPLEMENT}).withColumn("covered", covered)
    fits = F.lit(False)
    for part, others in COMPLEMENT.items():
        for other in others:
            fits = fits | ((F.col("part") == part) & F.col(f"near_{other}"))
    return marked.filter(F.col("weak") & ~F.col("covered") & fits).select("row_id", "low", "nth", "high")


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row as ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Spans are ``kind:start:end`` over the whole text in code points, by start and
    kind. Null texts count as empty; rows of one id stay apart; an empty table
    gives an empty result; other columns play no part.
    """
    found = {kind: spans_of(pattern, group, least if group else 0) for kind, pattern, group, least in BASE}
    found |= {kind: spans_of(pattern) for kind, _, pattern in WEAK}
    rows = saved_with_row_id(docs.select("doc_id", whole_text(text).alias("text")).withColumns(found).drop("text"))
    base = F.concat(*(_labelled(kind, i) for i, (kind, *_) in enumerate(BASE)))
    weak = F.concat(*(_labelled(kind, i + len(BASE)) for i, (kind, *_) in enumerate(WEAK)))
    rows = rows.select("row_id", "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k, *_ in BASE), base.alias("base"), weak.alias("weak"))

    part = F.element_at(F.array(*map(F.lit, [*STRONG_PART.values(), *(part for _, part, _ in WEAK)])), F.col("x.nth") + 1)
    parts = rows.filter(F.size("weak") > 0).select("row_id", F.explode(F.concat("base", "weak")).alias("x")).select(
        "row_id", part.alias("part"), (F.col("x.nth") >= len(BASE)).alias("weak"), "x.low", "x.high", "x.nth"
    )
    added = linked(parts).groupBy("row_id").agg(F.collect_list(F.struct("low", "nth", "high")).alias("added"))
    return rows.join(added, "row_id", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", F.coalesce("added", F.expr("array()").cast("array<struct<low:bigint,nth:int,high:bigint>>")))).alias("spans"),
    )
