"""Contract validation: rows get error codes, warning codes and a status, and are routed by it.

Survey ids P1, P4, P6, P7, P10, F1-F3, U3, A16. Layers cascade: field rules see rows of sound structure, cross-field rules
those without field errors; warnings see all rows of sound structure.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import Rule, any_of, codes, status_of

BUSINESS = ("VALID", "WARNING")
#: What a field of a kind may be.
ACCEPTS = {"string": ["string"], "integer": ["integer"], "number": ["integer", "number"], "integers": ["integers"]}


def _kind(kind: Column) -> Column:
    """The kind of a JSON value by its variant's schema; null for none, ``null`` for JSON null."""
    return (
        F.when(kind == "STRING", "string").when(kind == "BIGINT", "integer").when(kind.rlike(r"^(DOUBLE|FLOAT|DECIMAL\()"), "number")
        .when(kind == "ARRAY<BIGINT>", "integers").when(kind == "VOID", "null").when(kind.isNotNull(), "other")
    )


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    kind: str = "string"
    nullable: bool = False


@dataclass(frozen=True)
class Contract:
    version: str
    fields: tuple[Field, ...]
    field_rules: tuple[Rule, ...] = ()
    cross_rules: tuple[Rule, ...] = ()
    warning_rules: tuple[Rule, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)


def sound_schema(contract: Contract) -> str:
    """A pattern of the variant schemas of objects that have exactly the contract's fields, of their kinds and no required null.

    Variants list fields in order of name and quote names that are no identifiers, so no key can pass for several fields. A name
    that is sorted or quoted otherwise only sends its rows the longer way.
    """
    kinds = {"string": "STRING", "integer": "BIGINT", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)", "integers": "ARRAY<BIGINT>"}
    fields = sorted(contract.fields, key=lambda f: f.name)
    return "^OBJECT<" + ", ".join(f"{re.escape(f.name)}: (?:{kinds[f.kind]}{'|VOID' if f.nullable else ''})" for f in fields) + ">$"


#: Bytes of a text up to which :func:`plain_object` judges it.
PLAIN_BYTES = 1 << 20


def plain_object(contract: Contract) -> str:
    """A pattern of JSON texts that are such objects as they stand: the contract's fields in its order, each once and of its kind, no
    required null, texts without escapes and numbers of few digits.

    Each text that it matches has a schema by :func:`sound_schema`, and is judged without being parsed into a variant. Any other,
    sound or not, only goes the longer way. Its parts give nothing back, so a text is passed over once.
    """
    space, whole = r"[ \t\r\n]*+", r"-?+(?:0|[1-9][0-9]{0,16}+)"
    kinds = {
        "string": r'"[^"\\\x00-\x1f]*+"', "integer": whole, "number": whole + r"(?:\.[0-9]{1,15}+)?+(?:[eE][+-]?+[0-9]{1,2}+)?+",
        "integers": rf"\[{space}{whole}(?:{space},{space}{whole}){{0,63}}+{space}\]",
    }
    fields = [f'{re.escape(json.dumps(f.name, ensure_ascii=False))}{space}:{space}(?:{kinds[f.kind]}{"|null" if f.nullable else ""})' for f in contract.fields]
    return rf"^{space}\{{{space}" + f"{space},{space}".join(fields) + rf"{space}\}}{space}\z"


def validate_json(
    df: DataFrame, contract: Contract, raw: str = "raw_payload", strict: bool = False, stamp: bool = True
) -> DataFrame:
    """Adds payload, missing_fields, unexpected_fields, validation_errors, validation_warnings, validation_status,
    contract_version, the contract's fields as columns and, with ``stamp``, ingested_at.

    Structure comes first: E001 unreadable JSON (null text and repeated keys included), E002 no object, E003 missing and
    E004 unexpected fields, and where all fields are there E005 wrong types and E006 required nulls. A rule over a null value
    has no code unless ``strict``, which also flags (E005) a value that is not null in the text but null once typed, such as
    an integer of more than its bits.
    """
    names = contract.names
    required = F.array(*map(F.lit, names))
    none = F.array().cast("array<string>")
    schema = F.col("_schema")
    # a text that is plain has a schema that is known
    plain = F.coalesce((F.octet_length(raw) <= PLAIN_BYTES) & F.col(raw).rlike(plain_object(contract)), F.lit(False))
    known = F.when(F.col("_plain"), "OBJECT<").otherwise(F.schema_of_variant(F.try_parse_json(raw)))
    parsed = df.withColumn("_plain", plain).withColumns({"_schema": known, "payload": F.from_json(raw, contract.ddl)})
    sound = F.col("_plain") | F.coalesce(schema.rlike(sound_schema(contract)), F.lit(False))
    parsed = parsed.withColumns({"_sound": sound, "_object": F.coalesce(schema.startswith("OBJECT<"), F.lit(False))})

    def value(name: str) -> Column:
        return F.col(f"payload.`{name}`")

    # rows of the expected schema are done; only others are looked at field by field
    odd = ~F.col("_sound")
    if strict:
        odd = odd | any_of([value(n).isNull() for n in names])
    odd = F.col("_object") & odd
    fields = F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>")
    # the schema of a value is made once, not for each kind that it may be
    schemas = F.transform_values(fields, lambda _, v: F.schema_of_variant(v))
    parsed = parsed.withColumns({"_kinds": F.when(odd, F.transform_values(schemas, lambda _, s: _kind(s))), "_keys": F.when(odd, F.json_object_keys(raw))})
    parsed = parsed.withColumns(
        {
            "missing_fields": F.when(odd, F.array_except(required, "_keys")).when(F.col("_object"), none).otherwise(required),
            "unexpected_fields": F.when(odd, F.array_except("_keys", required)).otherwise(none),
        }
    )
    complete = F.col("_object") & (F.size("missing_fields") == 0)
    accepted = F.create_map(*[x for f in contract.fields for x in (F.lit(f.name), F.array(*map(F.lit, ACCEPTS[f.kind])))])
    needed = F.array(*[F.lit(f.name) for f in contract.fields if not f.nullable])
    entries = F.map_entries("_kinds")
    wrong = F.exists(
        entries, lambda e: e["value"].isNotNull() & (e["value"] != "null") & ~F.array_contains(F.try_element_at(accepted, e["key"]), e["value"])
    )
    missing = F.exists(entries, lambda e: (e["value"] == "null") & F.array_contains(needed, e["key"]))
    if strict:
        lost = [value(f.name).isNull() & (F.try_element_at("_kinds", F.lit(f.name)) != "null") for f in contract.fields]
        wrong = wrong | any_of(lost)
    structure = [
        Rule("E001_MALFORMED_JSON", lambda get: schema.isNull()),
        Rule("E002_TOP_LEVEL_NOT_OBJECT", lambda get: schema.isNotNull() & ~F.col("_object")),
        Rule("E003_MISSING_FIELDS", lambda get: F.col("_object") & (F.size("missing_fields") > 0)),
        Rule("E004_UNEXPECTED_FIELDS", lambda get: F.col("_object") & (F.size("unexpected_fields") > 0)),
        Rule("E005_TYPE_MISMATCH", lambda get: complete & wrong),
        Rule("E006_REQUIRED_NULL", lambda get: complete & missing),
    ]
    found = F.when(odd | ~F.col("_object"), codes(structure, value)).otherwise(none)
    parsed = parsed.withColumn("_structure", found)
    eligible = complete & (F.size("unexpected_fields") == 0) & (F.size("_structure") == 0)
    judged = _judged(parsed, contract, value, eligible, F.col("_structure"), strict)
    out = judged.withColumns({n: value(n) for n in names} | {"contract_version": F.lit(contract.version)})
    if stamp:
        out = out.withColumn("ingested_at", F.current_timestamp())
    return out.drop("_plain", "_schema", "_sound", "_keys", "_object", "_kinds", "_structure", "_eligible")


def validate_table(df: DataFrame, contract: Contract, strict: bool = False) -> DataFrame:
    """Adds validation_errors, validation_warnings and validation_status to rows that are typed already."""
    nulls = [F.col(f.name).isNull() for f in contract.fields if not f.nullable]
    structure = codes([Rule("E006_REQUIRED_NULL", lambda get: any_of(nulls))], F.col)
    ready = df.withColumn("_structure", structure)
    out = _judged(ready, contract, F.col, F.size("_structure") == 0, F.col("_structure"), strict)
    return out.drop("_structure", "_eligible")


def _judged(df: DataFrame, contract: Contract, get, eligible: Column, structure: Column, strict: bool) -> DataFrame:
    df = df.withColumn("_eligible", eligible)
    df = df.withColumn("_field", codes(contract.field_rules, get, F.col("_eligible"), strict))
    sound = F.col("_eligible") & (F.size("_field") == 0)
    df = df.withColumns(
        {
            "validation_errors": F.concat(structure, "_field", codes(contract.cross_rules, get, sound, strict)),
            "validation_warnings": codes(contract.warning_rules, get, F.col("_eligible")),
        }
    )
    status = status_of(F.col("validation_errors"), F.col("validation_warnings"))
    # a generator's output: filters on the status stay above it, else each would take a copy of the whole validation below itself
    found = F.struct("validation_errors", "validation_warnings", status.alias("validation_status"))
    once = df.withColumn("_found", F.explode(F.array(found))).drop("_field", "validation_errors", "validation_warnings", "validation_status")
    return once.select("*", "_found.*").drop("_found")


def route(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the clean table (VALID, WARNING) and rows for the dead-letter table (INVALID)."""
    status = F.col("validation_status")
    return validated.filter(status.isin(*BUSINESS)), validated.filter(status == "INVALID")


def status_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("validation_status").agg(F.count(F.lit(1)).alias("rows"))


def rule_counts(validated: DataFrame, codes_column: str = "validation_errors") -> DataFrame:
    """Rows per code, the most frequent first; an exploded row is one code, never a whole record."""
    counts = validated.select(F.explode(codes_column).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), "code")


def contradicts() -> Column:
    """Whether a row's status does not follow from its codes (P10)."""
    errors, warnings, status = F.size("validation_errors"), F.size("validation_warnings"), F.col("validation_status")
    return (
        ((status == "VALID") & ((errors > 0) | (warnings > 0)))
        | ((status == "WARNING") & ((errors > 0) | (warnings == 0)))
        | ((status == "INVALID") & (errors == 0))
        | ~status.isin("VALID", "WARNING", "INVALID")
        | status.isNull()
    )


def inconsistent(validated: DataFrame) -> DataFrame:
    """Rows whose status does not follow from their codes (P10)."""
    return validated.filter(contradicts())


def invalid_sample(validated: DataFrame, order: Sequence[str], rows: int = 20) -> DataFrame:
    """The first invalid rows in an order: a report, so it has a limit (O4)."""
    return validated.filter("validation_status = 'INVALID'").orderBy(*order).limit(rows)
