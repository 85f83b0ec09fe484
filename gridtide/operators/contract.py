"""The data contract: declared fields, coercion of records and reject reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions import coerce

_SPARK_TYPES = {
    "timestamp": T.TimestampType(),
    "integer": T.IntegerType(),
    "text": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = False
    lo: int | None = None
    hi: int | None = None


# The feed's columns in contract order. "required" means the key must exist in
# every record; lo..hi is the plausible range (MW, taux_co2 in g/kWh).
GRID_FIELDS = (
    Field("date_heure", "timestamp", required=True),
    Field("perimetre", "text"),
    Field("nature", "text"),
    Field("consommation", "integer", required=True, lo=20000, hi=110000),
    Field("prevision_j", "integer", lo=15000, hi=120000),
    Field("prevision_j1", "integer", lo=15000, hi=120000),
    Field("fioul", "integer", lo=0, hi=10000),
    Field("charbon", "integer", lo=0, hi=4000),
    Field("gaz", "integer", lo=0, hi=15000),
    Field("nucleaire", "integer", required=True, lo=0, hi=64000),
    Field("eolien", "integer", lo=0, hi=35000),
    Field("eolien_terrestre", "integer", lo=0, hi=30000),
    Field("eolien_offshore", "integer", lo=0, hi=10000),
    Field("solaire", "integer", lo=-300, hi=30000),
    Field("hydraulique", "integer", lo=0, hi=26000),
    Field("pompage", "integer", lo=-8000, hi=0),
    Field("bioenergies", "integer", lo=0, hi=4000),
    Field("ech_physiques", "integer", lo=-25000, hi=25000),
    Field("taux_co2", "integer", lo=0, hi=300),
    Field("ech_comm_angleterre", "integer", lo=-10000, hi=10000),
    Field("ech_comm_espagne", "integer", lo=-10000, hi=10000),
    Field("ech_comm_italie", "integer", lo=-10000, hi=10000),
    Field("ech_comm_suisse", "integer", lo=-10000, hi=10000),
    Field("ech_comm_allemagne_belgique", "integer", lo=-15000, hi=15000),
    Field("fioul_tac", "integer", lo=0, hi=5000),
    Field("fioul_cogen", "integer", lo=0, hi=5000),
    Field("fioul_autres", "integer", lo=0, hi=5000),
    Field("gaz_tac", "integer", lo=0, hi=5000),
    Field("gaz_cogen", "integer", lo=0, hi=8000),
    Field("gaz_ccg", "integer", lo=0, hi=12000),
    Field("gaz_autres", "integer", lo=0, hi=8000),
    Field("hydraulique_fil_eau_eclusee", "integer", lo=0, hi=15000),
    Field("hydraulique_lacs", "integer", lo=0, hi=12000),
    Field("hydraulique_step_turbinage", "integer", lo=0, hi=6000),
    Field("bioenergies_dechets", "integer", lo=0, hi=2000),
    Field("bioenergies_biomasse", "integer", lo=0, hi=2000),
    Field("bioenergies_biogaz", "integer", lo=0, hi=2000),
    Field("stockage_batterie", "integer", lo=-4000, hi=100),
    Field("destockage_batterie", "integer", lo=-100, hi=4000),
)


@dataclass(frozen=True)
class Layout:
    """What the operators need to know about a measurement table."""

    fields: tuple[Field, ...]
    key: str
    consumption: str
    sources: dict[str, str]
    flows: tuple[str, ...]
    co2: str
    #: Columns beside ``key`` that together with it tell rows apart.
    more_keys: tuple[str, ...] = ()

    @property
    def unique(self) -> list[str]:
        return [self.key, *self.more_keys]

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def bounded(self) -> list[Field]:
        return [field for field in self.fields if field.lo is not None]

    @property
    def parts(self) -> list[str]:
        return [*self.sources.values(), *self.flows]


GRID = Layout(
    fields=GRID_FIELDS,
    key="date_heure",
    consumption="consommation",
    # Mix label -> production column.
    sources={
        "nuclear": "nucleaire",
        "wind": "eolien",
        "solar": "solaire",
        "hydro": "hydraulique",
        "gas": "gaz",
        "oil": "fioul",
        "coal": "charbon",
        "bioenergy": "bioenergies",
    },
    # Signed flows completing consumption = production + flows.
    flows=("pompage", "ech_physiques", "stockage_batterie", "destockage_batterie"),
    co2="taux_co2",
)


def table_schema(fields: tuple[Field, ...] = GRID.fields) -> T.StructType:
    """Stored columns: the contract plus the load stamp."""
    columns = [T.StructField(f.name, _SPARK_TYPES[f.kind]) for f in fields]
    return T.StructType([*columns, T.StructField("ingested_at", T.TimestampType())])


def observed(consumption: str = GRID.consumption) -> str:
    """A row is observed, not only forecast, once its consumption is filled."""
    return f"{consumption} IS NOT NULL"


def apply_contract(
    records: DataFrame,
    fields: tuple[Field, ...] = GRID.fields,
    key: str = GRID.key,
    record: str = "record",
    seq: str = "seq",
    keep: tuple[str, ...] = (),
    more_keys: tuple[str, ...] = (),
) -> DataFrame:
    """JSON record text -> ``seq``, the coerced fields and ``reject``.

    ``reject`` is null for an accepted record, otherwise the first failure in
    contract order. Unknown keys vanish with the projection, an absent optional
    key is null. ``keep`` names further input columns to pass through; ``more_keys`` further
    columns that must not be null.

    Plain values take compiled casts only. The costly rules run just for records
    that need them, as array functions over the fields, which also keeps the
    generated code small whatever the number of fields: number texts that are no
    plain integer, the key list that tells an absent key from an explicit null,
    and the wording of a reject.
    """
    names = [f.name for f in fields]
    integers = [f.name for f in fields if f.kind == "integer"]
    texts = ", ".join(f"{name} STRING" for name in names)
    parse = f"from_json({record}, '{texts}', map('allowSingleQuotes', 'false')) AS _raw"
    passed = [seq, *keep, record, "_raw"]
    rows = records.selectExpr(seq, *keep, record, parse)

    first = {"integer": coerce.plain_integer, "timestamp": coerce.instant, "text": str}
    rows = rows.selectExpr(*passed, *[f"{first[f.kind](_raw(f.name))} AS {f.name}" for f in fields])
    if integers:
        cells = ", ".join(map(_raw, integers))
        second = f"transform(array({cells}), text -> {coerce.integer('text')})"
        reread = {n: f"coalesce({n}, _second[{at}]) AS {n}" for at, n in enumerate(integers)}
        rows = rows.selectExpr("*", f"CASE WHEN {_unread(integers)} THEN {second} END AS _second")
        rows = rows.selectExpr(*passed, *[reread.get(n, n) for n in names])

    # The key list is read once, and only where a required field or the key has no value.
    lacking = " OR ".join(f"{_raw(name)} IS NULL" for name in [key, *[f.name for f in fields if f.required and f.name != key]])
    rows = rows.selectExpr("*", f"CASE WHEN {lacking} THEN json_object_keys({record}) END AS _keys")
    keys = "_keys"
    suspect = [_unread([f.name for f in fields if f.kind != "text"])]
    suspect += [f"{name} IS NULL" for name in (key, *more_keys)]
    lacking_key = " ".join(f"WHEN {name} IS NULL THEN '{name} must not be null'" for name in (key, *more_keys))
    suspect += [
        f"({_raw(f.name)} IS NULL AND NOT coalesce(array_contains({keys}, '{f.name}'), false))"
        for f in fields
        if f.required
    ]
    reject = f"""CASE WHEN {' OR '.join(suspect)} THEN concat(
        CASE WHEN {_raw(key)} <> '' THEN {_raw(key)} ELSE '<no {key}>' END,
        ': ',
        coalesce(
          CASE WHEN {_raw(key)} IS NULL AND {keys} IS NULL THEN 'record is not an object' END,
          {_first_failure(fields, keys)},
          CASE {lacking_key} END)) END"""
    # A filter on plain projected columns would be pushed below the projections, with the parse
    # and every coercion copied into it. Generated columns stop that.
    return rows.select(F.inline(F.array(F.struct(seq, *keep, *names, F.expr(reject).alias("reject")))))


def _raw(name: str) -> str:
    return f"_raw.{name}"


def _unread(names: list[str]) -> str:
    """Some field has text but no value yet."""
    return "(" + " OR ".join(f"({_raw(n)} IS NOT NULL AND {n} IS NULL)" for n in names) + ")"


def _first_failure(fields: tuple[Field, ...], keys: str) -> str:
    """The first reason in contract order, from the fields laid out as an array."""
    cells = ", ".join(
        f"named_struct('name', '{f.name}', 'kind', '{f.kind}', "
        f"'required', {str(f.required).lower()}, 'raw', {_raw(f.name)})"
        for f in fields
    )
    reason = f"""CASE
        WHEN f.required AND f.raw IS NULL AND NOT array_contains({keys}, f.name)
          THEN concat('required field \\'', f.name, '\\' is missing')
        ELSE concat('field \\'', f.name, '\\': ', CASE f.kind
          WHEN 'integer' THEN {coerce.integer_why('f.raw')}
          WHEN 'timestamp' THEN {coerce.instant_why('f.raw')} END) END"""
    return f"get(filter(transform(array({cells}), f -> {reason}), why -> why IS NOT NULL), 0)"


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject").isNull()).drop("reject")


def rejected(rows: DataFrame, seq: str = "seq") -> DataFrame:
    return rows.where(F.col("reject").isNotNull()).select(seq, "reject")
