"""Data contracts: declared once, compiled to a suite, measured on Spark."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions import keys as K
from plumbline.functions import predicates as P
from plumbline.functions.keys import ForeignKey
from plumbline.operators import anomaly, checks as C, integrity, scores
from plumbline.operators.checks import Check, Suite
from plumbline.operators.validate import validate, violation


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    unique: bool = False
    primary: bool = False
    references: str | None = None
    classification: str | None = None
    constraints: tuple[dict, ...] = ()


@dataclass(frozen=True)
class Contract:
    id: str
    table: str | None
    version: str = "1.0.0"
    fields: tuple[Field, ...] = ()
    servicelevels: dict = field(default_factory=dict)
    rules: tuple[dict, ...] = ()
    anomaly_detection: dict = field(default_factory=dict)
    relationships: tuple[dict, ...] = ()

    def required_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def pii_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.classification == "PII"]


# --- reading and writing the multi-document form -------------------------------------------------------------------

def from_documents(docs: Iterable[Mapping]) -> list[Contract]:
    """Contracts from parsed documents of the Data Contract Specification layout."""
    contracts = []
    for doc in docs:
        if not doc:
            continue
        common = dict(id=doc["id"], version=str(doc.get("info", {}).get("version", "1.0.0")),
                      servicelevels=doc.get("servicelevels") or {}, rules=tuple(doc.get("rules") or ()),
                      anomaly_detection=doc.get("anomaly_detection") or {},
                      relationships=tuple((doc.get("referential_integrity") or {}).get("relationships") or ()))
        models = doc.get("models") or {None: {}}
        for table, model in models.items():
            fields = tuple(
                Field(name, spec["type"], bool(spec.get("required")), bool(spec.get("unique")),
                      bool(spec.get("primary")), spec.get("references"), spec.get("classification"),
                      tuple(spec.get("constraints") or ()))
                for name, spec in (model.get("fields") or {}).items())
            contracts.append(Contract(table=table, fields=fields, **common))
    return contracts


def from_yaml(text: str) -> list[Contract]:
    try:
        import yaml
    except ImportError as missing:  # only reading YAML needs it
        raise RuntimeError("reading YAML contracts needs PyYAML") from missing
    return from_documents(yaml.safe_load_all(text))


def to_document(contract: Contract) -> dict:
    """The contract as one document of the same layout."""
    fields = {}
    for f in contract.fields:
        spec = {"type": f.type, "required": f.required, "unique": f.unique, "primary": f.primary,
                "references": f.references, "classification": f.classification, "constraints": list(f.constraints)}
        fields[f.name] = {k: v for k, v in spec.items() if v not in (None, False, [])}
    doc = {"dataContractSpecification": "0.9.3", "id": contract.id, "info": {"version": contract.version}}
    if contract.table:
        doc["models"] = {contract.table: {"type": "table", "fields": fields}}
    extras = {"servicelevels": contract.servicelevels, "rules": list(contract.rules),
              "anomaly_detection": contract.anomaly_detection}
    if contract.relationships:
        extras["referential_integrity"] = {"relationships": list(contract.relationships)}
    return {**doc, **{k: v for k, v in extras.items() if v}}


def to_yaml(contracts: Iterable[Contract]) -> str:
    import yaml

    return yaml.safe_dump_all([to_document(c) for c in contracts], sort_keys=False, explicit_start=True)


# --- compiling -----------------------------------------------------------------------------------------------------

def _reference(target: str) -> tuple[str, str]:
    table, key = target.split(".")
    return table, key


CONSTRAINTS = {
    "not_null": lambda f, c: C.not_null(f.name, c.get("mostly", 1.0)),
    "unique": lambda f, c: C.unique(f.name),
    "range": lambda f, c: C.between(f.name, c.get("minimum"), c.get("maximum"), c.get("mostly", 1.0)),
    "pattern": lambda f, c: C.matches(f.name, c["regex"], c.get("mostly", 1.0)),
    "length": lambda f, c: C.length_between(f.name, c.get("minimum"), c.get("maximum"), c.get("mostly", 1.0)),
    "enum": lambda f, c: C.in_set(f.name, c["values"]),
    "cross_field": lambda f, c: C.row_rule(f.name, c["rule"], severity=c.get("severity")),
    "consistency": lambda f, c: C.row_rule(f.name, c["rule"], "Consistency"),
    "formula": lambda f, c: C.row_rule(f.name, c["rule"], severity="critical"),
    "referential_integrity": lambda f, c: C.references(f.name, *_reference(c["references"]), severity="critical"),
    "compound_unique": lambda f, c: C.compound_unique(*c["columns"]),
}


def field_checks(f: Field) -> list[Check]:
    """Checks of one field. A required field is a hard not-null check; a tolerated share of NULLs is a soft one."""
    found = [CONSTRAINTS[c["type"]](f, c) for c in f.constraints]
    kinds = {c.kind for c in found}
    if f.required and "not_null" not in kinds:
        found.insert(0, C.not_null(f.name))
    if (f.unique or f.primary) and "unique" not in kinds:
        found.append(C.unique(f.name))
    if f.references and "references" not in kinds:
        found.append(C.references(f.name, *_reference(f.references), severity="critical"))
    return found


def compile_suite(contract: Contract) -> Suite:
    """Schema check first, then every field in declared order."""
    found = [C.column_order(*[f.name for f in contract.fields])]
    for f in contract.fields:
        found.extend(field_checks(f))
    return Suite(f"{contract.table}_contract", contract.table, tuple(found))


def relationships(contracts: Iterable[Contract]) -> list[ForeignKey]:
    """All foreign keys of the policy documents, as checks can use them."""
    return [ForeignKey(r["source_column"], r["target_table"], r["target_column"], r.get("rule_id"),
                       r.get("severity", "critical"), r["source_table"])
            for c in contracts for r in c.relationships]


# --- measuring -----------------------------------------------------------------------------------------------------

# Declared types and the Spark types that satisfy them.
TYPES = {"bigint": {"bigint"}, "integer": {"int"}, "smallint": {"smallint", "int"}, "date": {"date"},
         "boolean": {"boolean"}}


def declared_length(declared: str) -> int | None:
    found = re.fullmatch(r"(?:var)?char\((\d+)\)", declared)
    return int(found.group(1)) if found else None


def type_fits(declared: str, actual: str) -> bool:
    if declared_length(declared) is not None:
        return actual == "string"
    return actual in TYPES.get(declared, {declared.replace(" ", "")})


def type_report(df: DataFrame, contract: Contract, stored: StructType | None = None) -> DataFrame:
    """column_name, declared_type, max_length, conforms. Text lengths come from one aggregate.

    Types come from ``stored``, the schema of the files, where it is given: a table read with its declared schema always
    has the declared types.
    """
    actual = {f.name: f.dataType.simpleString() for f in (stored or df.schema).fields}
    limits = {f.name: declared_length(f.type) for f in contract.fields}
    texts = [n for n, limit in limits.items() if limit is not None and actual.get(n) == "string"]
    lengths = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.max(F.length(n)).alias(n) for n in texts])
    rows = []
    for f in contract.fields:
        fits = str(type_fits(f.type, actual.get(f.name, "missing"))).lower()
        longest = f"cast({f.name} as bigint)" if f.name in texts else "cast(null as bigint)"
        ok = f"{fits} and coalesce({f.name}, 0) <= {limits[f.name]}" if f.name in texts else fits
        rows.append(f"named_struct('table_name', '{contract.table}', 'column_name', '{f.name}', "
                    f"'declared_type', '{f.type}', 'max_length', {longest}, 'conforms', {ok})")
    return lengths.selectExpr(f"inline(array({', '.join(rows)}))")


def pii_report(tables: Mapping[str, DataFrame], contracts: Iterable[Contract]) -> DataFrame:
    """Columns tagged as personal data with their filled values, one scan per table."""
    parts = []
    for c in contracts:
        names = c.pii_columns()
        if names:
            wide = tables[c.table].agg(*[F.count(n).alias(n) for n in names])
            parts.append(wide.unpivot([], names, "column_name", "filled").select(
                F.lit(c.table).alias("table_name"), "column_name", F.lit("PII").alias("classification"), "filled"))
    return reduce(DataFrame.unionByName, parts)


def with_classification(df: DataFrame, contract: Contract) -> DataFrame:
    """The table with its classification tags in the column metadata."""
    for f in contract.fields:
        if f.classification:
            df = df.withMetadata(f.name, {"classification": f.classification})
    return df


# Threshold of each rule in the rule catalogue.
RULE_THRESHOLD = {"R-001": 1.0, "R-002": 0.99, "R-003": 0.99, "R-004": 1.0, "R-005": 1.0, "R-006": 1.0, "R-007": 0.99,
                  "R-008": 1.0, "R-009": 1.0, "R-010": 1.0, "R-011": 1.0, "R-012": 0.999, "R-013": 1.0, "R-014": 1.0}


def rule_suites() -> dict[str, Suite]:
    """The rule catalogue as suites: every check carries its rule id and threshold."""
    from plumbline.functions.predicates import EMAIL
    from plumbline.plans.suites import SEGMENTS

    rules = {
        "dim_customer": [("R-001", C.not_null("customer_key")), ("R-001", C.not_null("customer_id")),
                         ("R-001", C.not_null("customer_name")), ("R-001", C.unique("customer_key")),
                         ("R-002", C.not_null("email")), ("R-003", C.matches("email", EMAIL)),
                         ("R-004", C.in_set("customer_segment", SEGMENTS)),
                         ("R-005", C.one_current_row("customer_id")), ("R-005", C.has_current_row("customer_id"))],
        "dim_product": [("R-006", C.between("list_price", 0.01, None)), ("R-007", C.margin("cost_price", "list_price"))],
        "fact_sales": [("R-008", C.references("customer_key", "dim_customer", "customer_key")),
                       ("R-009", C.references("date_key", "dim_date", "date_key")),
                       ("R-010", C.references("product_key", "dim_product", "product_key")),
                       ("R-011", C.references("store_key", "dim_store", "store_key")),
                       ("R-012", C.between("quantity", 1, None)),
                       ("R-013", C.revenue_identity()), ("R-014", C.profit_identity())],
    }
    return {table: Suite(f"{table}_rules", table, tuple(
        replace(check, rule_id=rule, mostly=RULE_THRESHOLD[rule]) for rule, check in listed))
        for table, listed in rules.items()}


def rule_report(tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """rule_id, table_name, checks, violations, threshold, status."""
    results = reduce(DataFrame.unionByName,
                     [validate(tables[t], s, tables, as_of=as_of) for t, s in rule_suites().items()])
    return results.groupBy("rule_id", "table_name").agg(
        F.count(F.lit(1)).alias("checks"), F.sum("unexpected_count").alias("violations"),
        F.max("mostly").alias("threshold"),
        F.when(F.count_if(F.col("status") == "FAIL") == 0, "PASS").otherwise("FAIL").alias("status"))


def _need(percentage: str) -> float:
    return float(Decimal(percentage.rstrip("%")) / 100)


def _judged(levels: DataFrame) -> DataFrame:
    return levels.withColumn("status", F.when(F.col("measured") >= F.col("required"), "MET").otherwise("MISSED"))


def _row_levels(tables: Mapping[str, DataFrame], table: str, contracts: list[Contract],
                day: str = "load_date") -> DataFrame | None:
    """Completeness, accuracy, integrity and volume levels of one table from ONE scan.

    Where a volume is asked for, the aggregate is taken by day first, and the days are then judged and added up; only a
    count of distinct days, which cannot be added up, then needs a second scan.
    """
    df, wanted, aggregates, volumes = tables[table], [], {"n": F.count(F.lit(1))}, {}
    own = [k for k in integrity.RELATIONSHIPS if k.source == table]
    if own and any(level in INTEGRITY_LEVELS or spec.get("no_orphans") for c in contracts
                   for level, spec in c.servicelevels.items()):
        df, flags = K.with_orphan_flags(df, own, tables)
        aggregates["linked"] = F.count_if(~reduce(lambda a, b: a | b, flags.values()))
    for i, c in enumerate(contracts):
        for level, spec in c.servicelevels.items():
            if level == "completeness" and c.table:
                names = c.required_columns()
                aggregates[f"filled{i}"] = reduce(lambda a, b: a + b, [F.count(n) for n in names])
                also = ("null", "null")
                if spec.get("no_orphans"):
                    also = ("linked", "n")
                if spec.get("no_gaps_in"):
                    gap = spec["no_gaps_in"]
                    aggregates[f"days{i}"] = F.count_distinct(F.col(gap))
                    aggregates[f"span{i}"] = F.date_diff(F.max(gap), F.min(gap)) + 1
                    also = (f"days{i}", f"span{i}")
                wanted.append((level, spec["percentage"], f"filled{i}", f"n * {len(names)}", *also, "null"))
            elif level == "accuracy":
                rules = [k for k in compile_suite(c).checks
                         if k.kind == "row_rule" or (k.kind == "matches" and k.mostly < 1)]
                broken = reduce(lambda a, b: a | b, [F.coalesce(violation(r, df), F.lit(False)) for r in rules] + [
                    F.coalesce(~F.expr(rule), F.lit(False)) for rule in spec.get("rules", [])])
                aggregates[f"accurate{i}"] = F.count_if(~broken)
                wanted.append((level, spec["percentage"], f"accurate{i}", "n", "null", "null", "null"))
            elif level in INTEGRITY_LEVELS and own:
                wanted.append((level, spec["percentage"], "linked", "n", "null", "null", "null"))
            elif level == "volume" and c.table:
                volumes[f"volume{i}"] = F.avg(F.when(_inside(spec), 1.0).otherwise(0.0))
                wanted.append((level, "100%", "null", "null", "null", "null", f"volume{i}"))
    if not wanted:
        return None
    if volumes:
        added = [name for name in aggregates if not name.startswith(("days", "span"))]
        before = F.avg("n").over(anomaly.days_before(day, anomaly.SHORT_FRAME))
        totals = (df.groupBy(day).agg(*[aggregates[name].alias(name) for name in added])
                  .withColumn("rolling", P.rounded(before, 6))
                  .agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in added],
                       *[e.alias(name) for name, e in volumes.items()]))
        apart = [aggregates[name].alias(name) for name in aggregates if name not in added]
        if apart:
            totals = totals.withColumn("apart", df.agg(F.struct(*apart).alias("apart")).scalar()).select("*", "apart.*")
    else:
        totals = df.agg(*[e.alias(name) for name, e in aggregates.items()])
    rows = ", ".join(
        f"named_struct('service_level', '{level}', 'part', bigint({part}), 'whole', bigint({whole}), 'part2', "
        f"bigint({part2}), 'whole2', bigint({whole2}), 'mean', double({mean}), 'required', {_need(percentage)!r}D)"
        for level, percentage, part, whole, part2, whole2, mean in wanted)
    shares = F.least(scores.share(F.col("part"), F.col("whole")).cast("double"),
                     scores.share(F.col("part2"), F.col("whole2")).cast("double"))
    return _judged(totals.selectExpr(f"inline(array({rows}))").select(
        F.lit(table).alias("table_name"), "service_level",
        F.when(F.col("service_level") == "volume", F.col("mean")).otherwise(shares).alias("measured"), "required"))


def _inside(spec: Mapping) -> Column:
    """Whether a day (n rows, ``rolling``: the mean of the days before) has the volume a level asks for."""
    enough = F.col("n") >= F.col("rolling") * spec.get("minimum_share_of_average", 0)
    return F.col("n").between(spec["minimum_daily_rows"], spec.get("maximum_daily_rows", 1 << 62)) & F.coalesce(
        enough, F.lit(True))


def _uniqueness(df: DataFrame, key: str, current: Mapping[str, str] | None) -> DataFrame:
    """``measured``: distinct keys over rows; with ``current`` (key, flag) or the share of its keys that have one current
    row at most, whichever is worse. Both come from one scan, as grouping sets."""
    if current is None:
        return scores.uniqueness(df, key).select(F.col("score").alias("measured"))
    groups = (df.select(F.col(key).alias("k"), F.col(current["key"]).alias("c"), F.col(current["flag"]).alias("f"))
              .groupingSets([[F.col("k")], [F.col("c")]], "k", "c")
              .agg(F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n"), F.count_if("f").alias("open")))
    by_key, by_other = F.col("set") == 1, F.col("set") == 2
    return (groups.agg(F.count_if(by_key & F.col("k").isNotNull()).alias("keys"),
                       F.coalesce(F.sum(F.when(by_key, F.col("n"))), F.lit(0)).alias("rows"),
                       F.count_if(by_other & (F.col("open") <= 1)).alias("single"), F.count_if(by_other).alias("others"))
            .select(F.least(scores.share(F.col("keys"), F.col("rows")).cast("double"),
                            scores.share(F.col("single"), F.col("others")).cast("double")).alias("measured")))


def _asked(contracts: Iterable[Contract], level: str, policy_table: str) -> list[dict[str, dict]]:
    """Table -> what is asked of it, for one level. A table that several contracts name is in several dicts."""
    found: list[dict[str, dict]] = []
    for c in contracts:
        if level in c.servicelevels:
            table = c.table or policy_table
            room = next((d for d in found if table not in d), None)
            if room is None:
                found.append(room := {})
            room[table] = c.servicelevels[level]
    return found


def _log_level(measured: DataFrame, level: str, required: Mapping[str, float]) -> DataFrame:
    """Judged rows of one level from (table_name, measured) of several tables."""
    need = F.create_map(*[F.lit(v) for item in required.items() for v in item])
    return _judged(measured.select("table_name", F.lit(level).alias("service_level"), "measured",
                                   need[F.col("table_name")].alias("required")))


INTEGRITY_LEVELS = ("consistency", "referential_integrity")


def service_levels(tables: Mapping[str, DataFrame], contracts: Iterable[Contract], log: DataFrame | None = None,
                   as_of: str | None = None, policy_table: str = "fact_sales") -> DataFrame:
    """Measured against required share for every level, plus freshness and punctuality where a load log is given.

    A level that states two conditions is as good as the worse one. Punctuality is judged over the 30 days before
    ``as_of``; a table that never loaded misses both levels. A policy contract without a table of its own is judged on ``policy_table``.
    """
    contracts, parts = list(contracts), []
    by_table: dict[str, list[Contract]] = {}
    for c in contracts:
        by_table.setdefault(c.table or policy_table, []).append(c)
    parts += [p for p in (_row_levels(tables, t, listed) for t, listed in by_table.items()) if p is not None]
    for c in contracts:
        spec = c.servicelevels.get("uniqueness")
        if spec:
            key = next(f.name for f in c.fields if f.primary)
            parts.append(_log_level(_uniqueness(tables[c.table], key, spec.get("one_current_row")).select(
                F.lit(c.table).alias("table_name"), "measured"), "uniqueness", {c.table: _need(spec["percentage"])}))
    if log is not None:
        last = dt.date.fromisoformat(as_of[:10]) - dt.timedelta(days=1)
        for asked in _asked(contracts, "availability", policy_table):
            on_time = scores.load_punctuality(log, str(last - dt.timedelta(days=29)), str(last),
                                              {t: anomaly.SCHEDULE.get(t, ("daily", 6)) for t in asked})
            parts.append(_log_level(on_time.select("table_name", (F.col("timeliness_pct") / 100).alias("measured")),
                                    "availability", {t: _need(spec["percentage"]) for t, spec in asked.items()}))
        for asked in _asked(contracts, "freshness", policy_table):
            age = anomaly.freshness_age(log.where(F.col("table_name").isin(*asked)), as_of,
                                        {t: _hours(spec["threshold"]) for t, spec in asked.items()})
            fresh = F.when(F.col("status") == "FRESH", 1.0).otherwise(0.0)
            parts.append(_log_level(age.select("table_name", fresh.alias("measured")), "freshness",
                                    dict.fromkeys(asked, 1.0)))
    return reduce(DataFrame.unionByName, parts)


def _hours(threshold: str) -> int:
    """A duration such as 24h or 7d in hours."""
    return int(threshold[:-1]) * {"h": 1, "d": 24}[threshold[-1]]


def integrity_checks(tables: Mapping[str, DataFrame], contracts: Iterable[Contract]) -> DataFrame:
    """All foreign keys of the policy, checked together."""
    return integrity.orphan_report(tables, tuple(relationships(contracts)))


def anomaly_rules(contract: Contract, rows: DataFrame, log: DataFrame, as_of: str, day: str = "load_date",
                  measure: str = "net_revenue") -> DataFrame:
    """rule, severity, evaluated, triggered for the anomaly rules of a contract."""
    low = F.col("row_count") < F.col("rolling_7d_avg") * 0.5
    parts, declared = [], contract.anomaly_detection
    counted = lambda df, hit: df.agg(F.count(F.lit(1)).alias("evaluated"), F.count_if(hit).alias("triggered"))
    if "volume" in declared:
        parts.append(("volume", counted(anomaly.volume_bands(rows, day), low)))
    if "freshness" in declared:
        age = anomaly.freshness_age(log.where(F.col("table_name") == contract.table), as_of, {contract.table: 24})
        parts.append(("freshness", counted(age, F.col("status") == "STALE")))
    if "revenue_spike" in declared:
        parts.append(("revenue_spike", counted(anomaly.revenue_spikes(rows, day, measure), F.col("spike"))))
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(rule).alias("rule"), F.lit(declared[rule]["severity"]).alias("severity"),
                  "evaluated", "triggered") for rule, df in parts])
