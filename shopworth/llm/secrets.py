"""Secrets in texts: patterns, and weak parts that only count beside what completes them."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from shopworth.llm.common import col, map_batches
from shopworth.sources import pin

# The base patterns, the kinds in the order of their listing, and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
# Weak parts: a long mixed string, an address, the name of an account.
KEY = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"(?:https?|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{4,}")
ACCOUNT = re.compile(
    r"""(?<![a-z_])(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    re.ASCII | re.IGNORECASE,
)
KINDS = (*BASE, "key", "endpoint", "account")
#: What completes each weak kind.
COMPLETED_BY = {
    "key": ("access", "account", "endpoint"),
    "endpoint": ("assign", "access", "key"),
    "account": ("assign", "hex", "key"),
}
#: Characters on either side within which parts belong together.
SCOPE = 300
#: Bits per character that a weak key has at least.
ENTROPY = 4.0

_HINT = re.compile(r"password|passwd|secret|token|api_?key")
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns that are long enough, by start and then kind."""
    found = []
    if _HINT.search(text.lower()):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return _in_order(found)


def _in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak parts that no base span overlaps."""
    found = []
    for m in KEY.finditer(text):
        mixed = all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))
        if mixed and _entropy(m[0]) >= ENTROPY:
            found.append(("key", *m.span()))
    if "://" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if ":" in text or "=" in text:
        found += [("account", *m.span()) for m in ACCOUNT.finditer(text)]
    if not base or not found:
        return found
    clear, at, reach = [], 0, -1
    for span in sorted(found, key=lambda s: s[1]):  # both sides move on together
        while at < len(base) and base[at][1] < span[2]:
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= span[1]:
            clear.append(span)
    return clear


def _parts(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` with a row number, base spans and weak spans."""
    span = StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = StructType([df.schema[c] for c in keep]).add("_row", "long")
    for side in ("_base", "_weak"):
        schema = schema.add(side, ArrayType(span))
    names = schema.names

    def run(batches):
        for batch in batches:
            base, weak = [], []
            for value in batch.column(len(keep) + 1):
                value = value.as_py() or ""
                found = base_spans(value)
                base.append(found)
                weak.append(weak_spans(value, found))
            columns = [batch.column(i) for i in range(len(keep) + 1)]
            columns += [
                pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in side], _SPANS_ARROW)
                for side in (base, weak)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = df.select(*map(col, keep), F.monotonically_increasing_id().alias("_row"), col(text).alias("_text"))
    return map_batches(rows, run, schema)


def _linked(parts: DataFrame) -> DataFrame:
    """``_row, kind, start, end`` of weak parts beside one that completes them.

    An interval join: completing parts lie in all the stretches of ``SCOPE``
    characters they touch, weak ones look in all their scope touches. Both are
    joined by row and stretch, so a document full of parts is spread out and no
    stretch holds more than its few characters can.
    """
    all_parts = parts.select("_row", F.explode(F.concat("_base", "_weak")).alias("p")).select("_row", "p.*")
    pairs = F.create_map(*[F.lit(x) for k, v in COMPLETED_BY.items() for x in (k, ",".join(v))])
    near = F.explode(F.sequence(F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE)))
    there = all_parts.select(
        "_row", F.col("kind").alias("_kind"), F.col("start").alias("_start"), F.col("end").alias("_end"), near.alias("_bin")
    )
    weak = parts.select("_row", F.explode("_weak").alias("p")).select("_row", "p.*")
    low, high = F.floor((F.col("start") - SCOPE) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE)
    asking = weak.select(
        "_row", "kind", "start", "end", pairs[F.col("kind")].alias("_wanted"), F.explode(F.sequence(low, high)).alias("_bin")
    )
    close = (
        (asking["_row"] == there["_row"])
        & (asking["_bin"] == there["_bin"])
        & F.array_contains(F.split("_wanted", ","), F.col("_kind"))
        & (F.col("_start") < F.col("end") + SCOPE)
        & (F.col("_end") > F.col("start") - SCOPE)
    )
    return asking.join(there, close, "left_semi").select("_row", "kind", "start", "end").distinct()


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) with ``base_spans`` and ``spans``.

    Both list kind, start and end (exclusive) in code points, by start and then
    kind. ``spans`` adds weak parts - long mixed strings, addresses, account names -
    where a part that completes them lies within ``SCOPE`` characters. The text may
    be kept. A null or empty text has no spans. Repeated rows stay. Columns called
    like a result are dropped.

    The rows are written once with the parts found in them; only rows with weak
    parts are joined.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    keep = [c for c in keep if c.lower() not in ("base_spans", "spans", "_row", "_base", "_weak")]
    parts = pin(_parts(df, keep, text))
    asking = parts.where(F.size("_weak") > 0)
    linked = _linked(asking.select("_row", "_base", "_weak"))
    each = linked.groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_more"))
    none = F.array().cast(SPANS)
    joined = asking.join(each.withColumnRenamed("_row", "_of"), F.col("_row") == F.col("_of"), "left")
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    sortable = F.transform(
        F.concat("_base", F.coalesce("_more", none)),
        lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("n"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    merged = F.transform(F.sort_array(sortable), lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(SPANS)
    columns = [*map(col, keep), F.col("_base").alias("base_spans")]
    plain = parts.where(F.size("_weak") == 0).select(*columns, F.col("_base").alias("spans"))
    return joined.select(*columns, merged.alias("spans")).union(plain)


def as_text(spans: str):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redacted(text: str, spans: str, mark: str = "[secret]"):
    """The text with every span replaced; spans that overlap are one."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(a, s):
        fresh = F.when(s["start"] >= a["at"], F.concat(a["out"], F.substr(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.coalesce(fresh, a["out"]).alias("out"))

    def finish(a):
        return F.concat(a["out"], F.substr(F.col(text), a["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(F.col(text))
