"""Split of application log lines (PIP-01 .. PIP-03).

A line is parsed once. The five outputs are either selected from the parsed lines or, for a
topic sink, built as one array of tagged messages per line in a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow.functions import compute_once
from rillflow.schemas import LOG_LINE, PAGE_ACTION, PAGE_DISPLAY, PAGE_LOG, START_LOG

# The topics of the outputs.
TOPICS = {
    "page": "DWD_PAGE_LOG_TOPIC_1018",
    "display": "DWD_PAGE_DISPLAY_TOPIC_1018",
    "action": "DWD_PAGE_ACTION_TOPIC_1018",
    "start": "DWD_START_LOG_TOPIC_1018",
    "error": "DWD_ERROR_LOG_TOPIC_1018",
}

BAD = "_bad"


def parsed(lines: DataFrame, text: str = "value") -> DataFrame:
    """(line, log, kind): kind is error, log or reject.

    ``err`` may hold any object and decides first. A line with neither ``err`` nor
    ``common`` is a reject, and so is one that is no JSON object.
    """
    schema = StructType([*LOG_LINE.fields]).add(BAD, "string")
    log = F.from_json("line", schema, {"columnNameOfCorruptRecord": BAD})
    kind = (
        F.when(F.col(f"log.{BAD}").isNotNull(), "reject")
        .when(F.col("log.err").isNotNull(), "error")
        .when(F.col("log.common").isNotNull(), "log")
        .otherwise("reject")
    )
    logs = compute_once(lines.select(F.col(text).alias("line")), "log", log)
    return logs.withColumn("kind", kind)


# -- fields of the outputs: record field <- log field (fixed values) -----------


def _number(value: Column) -> Column:
    return value.try_cast("bigint")


def _common() -> dict[str, Column]:
    names = {
        "mid": "mid", "user_id": "uid", "province_id": "ar", "channel": "ch", "is_new": "is_new",
        "model": "md", "operate_system": "os", "version_code": "vc", "brand": "ba",
    }
    fields = {to: F.col(f"log.common.{name}") for to, name in names.items()}
    return fields | {"ts": _number(F.col("log.ts"))}


def _page() -> dict[str, Column]:
    return _common() | {
        "page_id": F.col("log.page.page_id"), "last_page_id": F.col("log.page.last_page_id"),
        "page_item": F.col("log.page.item"), "page_item_type": F.col("log.page.item_type"),
        "during_time": _number(F.col("log.page.during_time")), "sourceType": F.col("log.page.source_type"),
    }


def _display(d: Column) -> dict[str, Column]:
    return _page() | {
        "display_type": d["display_type"], "display_item": d["item"],
        "display_item_type": d["item_type"], "display_order": d["order"],
        "display_pos_id": d["pos_id"],
    }


def _action(a: Column) -> dict[str, Column]:
    return _page() | {
        "action_id": a["action_id"], "action_item": a["item"],
        "action_item_type": a["item_type"], "action_ts": _number(a["ts"]),
    }


def _start() -> dict[str, Column]:
    return _common() | {
        "entry": F.col("log.start.entry"), "open_ad_id": F.col("log.start.open_ad_id"),
        "loading_time_ms": _number(F.col("log.start.loading_time")),
        "open_ad_ms": _number(F.col("log.start.open_ad_ms")),
        "open_ad_skip_ms": _number(F.col("log.start.open_ad_skip_ms")),
    }


def _ordered(fields: dict[str, Column], schema: StructType) -> list[Column]:
    return [fields[name].alias(name) for name in schema.fieldNames()]


# -- outputs as tables -----------------------------------------------------------


def _with(logs: DataFrame, part: str) -> DataFrame:
    return logs.where((F.col("kind") == "log") & F.col(f"log.{part}").isNotNull())


def pages(logs: DataFrame) -> DataFrame:
    return _with(logs, "page").select(*_ordered(_page(), PAGE_LOG))


def displays(logs: DataFrame) -> DataFrame:
    """Displays with their page's context; without a page there are none (PIP-02)."""
    each = _with(logs, "page").withColumn("_d", F.explode("log.displays"))
    return each.select(*_ordered(_display(F.col("_d")), PAGE_DISPLAY))


def actions(logs: DataFrame) -> DataFrame:
    """Actions with their page's context and their own time (PIP-03)."""
    each = _with(logs, "page").withColumn("_a", F.explode("log.actions"))
    return each.select(*_ordered(_action(F.col("_a")), PAGE_ACTION))


def starts(logs: DataFrame) -> DataFrame:
    """Application starts, with or without a page."""
    return _with(logs, "start").select(*_ordered(_start(), START_LOG))


def errors(logs: DataFrame) -> DataFrame:
    """Whole lines with an error, split no further."""
    return logs.where(F.col("kind") == "error").select("line")


def rejects(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("kind") == "reject").select("line")


# -- outputs as messages -----------------------------------------------------------


def split_messages(lines: DataFrame, text: str = "value") -> DataFrame:
    """All outputs of all lines as (topic, value) in one pass."""
    none = F.array().cast("array<struct<topic:string,value:string>>")

    def tagged(kind: str, value: Column) -> Column:
        return F.struct(F.lit(TOPICS[kind]).alias("topic"), value.alias("value"))

    def json(kind: str, fields: dict[str, Column], schema: StructType) -> Column:
        return tagged(kind, F.to_json(F.struct(*_ordered(fields, schema))))

    def each(items: str, make) -> Column:
        return F.coalesce(F.transform(items, make), none)

    of_page = F.concat(
        F.array(json("page", _page(), PAGE_LOG)),
        each("log.displays", lambda d: json("display", _display(d), PAGE_DISPLAY)),
        each("log.actions", lambda a: json("action", _action(a), PAGE_ACTION)),
    )
    of_start = F.array(json("start", _start(), START_LOG))
    outputs = (
        F.when(F.col("kind") == "error", F.array(tagged("error", F.col("line"))))
        .when(
            F.col("kind") == "log",
            F.concat(
                F.when(F.col("log.page").isNotNull(), of_page).otherwise(none),
                F.when(F.col("log.start").isNotNull(), of_start).otherwise(none),
            ),
        )
        .otherwise(none)
    )
    return parsed(lines, text).select(F.inline(outputs))
