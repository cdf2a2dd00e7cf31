"""RADIUS session messages (JSON text) to typed rows.

Two layouts exist: ``HA`` (3G) and ``PGW`` (4G/NB). A message that cannot be
used stays in the table as a marked row: its first column is ``"1"`` when the
text is no JSON object and ``"0"`` when a key is missing, a value is not text
or the time is unusable; the raw text is kept in ``radiustime``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import MISSING
from .times import m5_of_text

NOT_AN_OBJECT = "1"
UNUSABLE = "0"
PARTITION_COLUMNS = ("d", "h", "m5")


@dataclass(frozen=True)
class RadiusLayout:
    """``keys`` are the JSON keys in output order, always needed. ``on_start``
    and ``on_stop`` are (JSON key, output column) pairs needed for that status
    only; the column is ``''`` otherwise. ``radiustime`` comes from StartTime
    or StopTime."""

    name: str
    keys: tuple[str, ...]
    on_start: tuple[tuple[str, str], ...] = ()
    on_stop: tuple[tuple[str, str], ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        body = [k.lower() for k in self.keys]
        body += [col for _, col in self.on_start]
        body.append("radiustime")
        body += [col for _, col in self.on_stop]
        return (*body, *PARTITION_COLUMNS)


# Message keys in the order of the output columns.
HA = RadiusLayout(
    "ha",
    keys=(
        "BSID", "CDMAIMSI", "CELLID", "CorrelationID", "Duration", "EventTimestamp",
        "HAServiceAddress", "IPAddr", "InputOctets", "MDN", "NID", "NetType", "OutputOctets",
        "RecvTime", "SID", "ServiceOption", "ServicePCF", "SessionID", "Status",
        "TerminateCause", "UserName",
    ),
    on_start=(("BeginSession", "beginSession"),),
    on_stop=(("SessionContinue", "sessioncontinue"),),
)
PGW = RadiusLayout(
    "pgw",
    keys=(
        "APN", "BSID", "CELLID", "Duration", "EventTimestamp", "GGSNAddress", "IMEI", "IPAddr",
        "InputOctets", "LTEIMSI", "MDN", "NASIPAddress", "NetType", "OutputOctets", "RatType",
        "RecvTime", "SGSNAddress", "SessionID", "Status", "TerminateCause",
    ),
)


def parse_messages(df: DataFrame, layout: RadiusLayout, value: str = "value", kept: Sequence[str] = ()) -> DataFrame:
    """One row per message, columns as ``layout.columns``, all text, then the columns ``kept`` of ``df`` as they are."""
    # Each step leaves a generator, which later filters do not pass: a message
    # is parsed and checked once, whatever is asked of its fields.
    raw = F.col(value)
    docs = df.select(*kept, raw.alias("_raw"), F.explode(F.array(F.try_parse_json(raw))).alias("_doc"))
    kinds = F.replace(F.replace(F.schema_of_variant("_doc"), F.lit("OBJECT<"), F.lit("{, ")), F.lit(">"), F.lit(","))
    shapes = docs.select(*kept, "_raw", "_doc", F.explode(F.array(kinds)).alias("_kinds"))
    # Fields are looked up in the parsed message, each once.
    names = dict.fromkeys([*layout.keys, *[k for k, _ in (*layout.on_start, *layout.on_stop)], "StartTime", "StopTime"])
    is_object = F.coalesce(F.col("_kinds").startswith("{"), F.lit(False))
    message = F.when(is_object, F.struct(*[F.try_variant_get("_doc", f"$.{n}", "string").alias(n) for n in names]))
    fields = shapes.select(*kept, "_raw", "_doc", "_kinds", F.explode(F.array(message)).alias("_msg"))
    starting = F.coalesce(_text("Status") == "Start", F.lit(False))
    start_keys = [*layout.keys, *[k for k, _ in layout.on_start], "StartTime"]
    stop_keys = [*layout.keys, *[k for k, _ in layout.on_stop], "StopTime"]
    checked = F.struct(
        starting.alias("_starting"),
        F.when(starting, _all_text(start_keys)).otherwise(_all_text(stop_keys)).alias("_usable"),
        F.when(starting, _text("StartTime")).otherwise(_text("StopTime")).alias("_time"),
    )
    typed = fields.select(*kept, "_raw", "_msg", F.inline(F.array(checked)))
    parts = m5_of_text(F.col("_time"))
    has_object = F.col("_msg").isNotNull()
    good = has_object & F.col("_usable") & parts["m5"].isNotNull()
    judged = F.struct(good.alias("_good"), *[c.alias(n) for n, c in parts.items()])
    typed = typed.select(*kept, "_raw", "_msg", "_starting", "_time", F.inline(F.array(judged)))
    good = F.col("_good")
    code = F.when(has_object, F.lit(UNUSABLE)).otherwise(F.lit(NOT_AN_OBJECT))

    def or_missing(c: Column) -> Column:
        return F.when(good, c).otherwise(F.lit(MISSING))

    out: dict[str, Column] = {k.lower(): or_missing(_text(k)) for k in layout.keys}
    first = layout.keys[0]
    out[first.lower()] = F.when(good, _text(first)).otherwise(code)
    for key, col in layout.on_start:
        out[col] = or_missing(F.when(F.col("_starting"), _text(key)).otherwise(F.lit("")))
    out["radiustime"] = F.when(good, F.col("_time")).otherwise(F.col("_raw"))
    for key, col in layout.on_stop:
        out[col] = or_missing(F.when(F.col("_starting"), F.lit("")).otherwise(_text(key)))
    for part in PARTITION_COLUMNS:
        out[part] = or_missing(F.col(part))
    return typed.select(*[out[c].alias(c) for c in layout.columns], *kept)


def bad_rows(df: DataFrame, layout: RadiusLayout) -> DataFrame:
    """The marked rows of a parsed table, for quarantine and counting."""
    return df.where(F.col("m5") == MISSING)


def _text(key: str) -> Column:
    return F.col("_msg")[key]


def _all_text(keys: list[str]) -> Column:
    """Every key is present and holds text or JSON null.

    The types of a flat object are read off its schema text, most often by
    comparing it with that of a message of exactly these keys. An object with
    inner objects, or with keys that had to be quoted there, is looked up key
    by key instead.
    """
    kinds = F.col("_kinds")
    usual = "{" + "".join(f", {key}: STRING" for key in sorted(keys)) + ","
    plain = (F.instr(F.substring(kinds, 2, 1 << 30), "{") == 0) & ~kinds.contains("`")
    listed = F.lit(True)
    for key in keys:
        listed = listed & (kinds.contains(f", {key}: STRING,") | kinds.contains(f", {key}: VOID,"))
    by_key = F.try_variant_get("_doc", "$", "map<string,variant>")

    def is_wanted(key: Column, v: Column) -> Column:
        return key.isin(keys) & F.schema_of_variant(v).isin("STRING", "VOID")

    looked_up = F.size(F.map_filter(by_key, is_wanted)) == len(keys)
    return F.when(kinds == usual, True).when(plain, listed).otherwise(looked_up)
