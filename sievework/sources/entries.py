"""Lists of reference entries from JSON rows: typed fields, faults of type and format, ids from a lock map."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Field(NamedTuple):
    """What a field of an entry holds: one string, or a list of them; ``pattern`` fits the whole of each string."""

    many: bool = False
    required: bool = False
    pattern: str | None = None


#: What an id field says where an entry has none, on purpose.
NO_ID = "none"


def _raw(name: str) -> Column:
    return F.try_variant_get("_v", f"$.{name}", "variant")


def _kind(name: str) -> Column:
    return F.coalesce(F.schema_of_variant(_raw(name)), F.lit("VOID"))


def _value(name: str, field: Field) -> Column:
    """The trimmed string, null if blank or of another type; or the trimmed strings of a list, blank ones left out."""
    if not field.many:
        bare = F.trim(F.try_variant_get("_v", f"$.{name}", "string"))
        return F.when((_kind(name) == "STRING") & (bare != ""), bare)
    some = F.transform(F.try_variant_get("_v", f"$.{name}", "array<string>"), lambda x: F.trim(x))
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(_kind(name) == "ARRAY<STRING>", F.filter(some, lambda x: x.isNotNull() & (x != ""))), none)


def _faults(name: str, field: Field, value: Column) -> list[Column]:
    """(rule, message) of a field's faults, null where there is none."""
    of = lambda rule, bad, message: F.when(bad, F.struct(F.lit(f"{rule}_{name}").alias("rule"), message.alias("message")))
    good = ("VOID", "ARRAY<STRING>", "ARRAY<VOID>") if field.many else ("VOID", "STRING")
    wanted = "a list of strings" if field.many else "a string"
    out = [of("type", ~_kind(name).isin(*good), F.concat(F.lit(f"expected {wanted}, got "), _kind(name)))]
    if field.required:
        missing = F.size(value) == 0 if field.many else value.isNull()
        out.append(of("required", missing & _kind(name).isin(*good), F.lit("is required")))
    if field.pattern:
        every = value if field.many else F.array_compact(F.array(value))
        bad = F.filter(every, lambda x: ~F.rlike(x, F.lit(f"^(?:{field.pattern})$")))
        out.append(of("format", F.size(bad) > 0, F.concat(F.lit("is "), F.array_join(bad, ", "))))
    return out


def load_entries(rows: DataFrame, entry: str, fields: dict[str, Field]) -> DataFrame:
    """``rows`` with a column for each of ``fields`` of their JSON object ``entry``, and ``faults``, an array of (rule, message).

    A value of another type counts as missing, with a fault; what is no JSON object has the fault ``no_entry`` alone and no values.  Fields that are not
    named are passed over.
    """
    parsed = rows.withColumn("_v", F.try_parse_json(entry))
    sound = F.startswith(F.coalesce(F.schema_of_variant("_v"), F.lit("VOID")), F.lit("OBJECT"))
    parsed = parsed.withColumns({name: _value(name, f) for name, f in fields.items()})
    found = F.array_compact(F.array(*[x for name, f in fields.items() for x in _faults(name, f, F.col(name))]))
    alone = F.array(F.struct(F.lit("no_entry").alias("rule"), F.lit("is no entry").alias("message")))
    return parsed.withColumn("faults", F.when(sound, found).otherwise(alone)).drop("_v")


def apply_lock(entries: DataFrame, lock: DataFrame, key: Column, own: str = "qid") -> DataFrame:
    """``entries`` with their ids: an entry's own, else that of ``lock(key, id)`` under its key; and ``no_id`` where it says that it has none.

    A lock's key may stand in it once; of several ids the least counts.  An entry without an id on purpose keeps none, whatever the lock says.
    """
    held = lock.groupBy(F.col("key").alias("_key")).agg(F.min("id").alias("_id"))
    none = F.coalesce(F.col(own) == NO_ID, F.lit(False))
    out = entries.withColumn("_at", key).join(held, F.col("_at") == F.col("_key"), "left")
    return out.withColumns({own: F.when(~none, F.coalesce(own, "_id")), "no_id": none}).drop("_at", "_key", "_id")
