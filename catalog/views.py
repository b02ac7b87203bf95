"""Stand-in views: the supplied tables hold no patients, so columns are derived from them.

Every view covers its whole source table. `sql_views` states the same in SQL for the cross-check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelattice.operators.skew import dealt
from carelattice.session import configure

# Names given to customers by arithmetic on their keys. The first ten have nicknames.
GIVEN_NAMES = (
    "Robert William Richard James Elizabeth Margaret Katherine Michael Christopher Jennifer "
    "Mila Noah Ava Liam Zoe Omar Ingrid Bo Yusuf Chiara Pedro Anneliese Tom Svetlana Kofi Li "
    "Priya Mateus Hannah Dmitri Leila Jo Fatima Andre Nancy Hugo Sienna Ray Greta Ivan"
).split()
FAMILY_NAMES = (
    "Smith Johnson Garcia Nguyen Kowalski Okafor Schmidt Rossi Tanaka Silva Ng Petrov Haddad "
    "Larsen Moreau Abernathy Fitzgerald Wu Castillo Ivanova Brown Oconnell Mueller Dubois Sato "
    "Reyes Lind Achebe Novak Tran Weber Costa Singh Kaya Mensah Bauer Ortiz Ali Horvath Ek Vance Quist Ames"
).split()

# Clinical codes standing in for line attributes.
CONDITION_BY_FLAG = {"A": "44054006", "R": "38341003", "N": "195662009"}
LAB_BY_LINE = {1: "39156-5", 2: "8480-6", 3: "8462-4", 4: "8867-4", 5: "2339-0", 6: "4548-4", 7: "2093-3"}

_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Supplied tables under one folder, and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        # Known schemas save the footer job of every further read.
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # -- clinical ------------------------------------------------------------------------------

    def encounter(self) -> DataFrame:
        o = self.raw("orders")
        key = F.col("o_orderkey")
        start = F.col("o_orderdate").cast("timestamp")
        stop = start + F.make_dt_interval(days=F.pmod(key, F.lit(7)).cast("int"))
        return o.select(
            key.alias("encounter_id"),
            F.col("o_custkey").alias("patient_id"),
            start.alias("start_ts"),
            F.when(key % 50 != 0, stop).alias("stop_ts"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "inpatient")
            .otherwise("ambulatory")
            .alias("encounter_class"),
            F.col("o_totalprice").alias("base_cost"),
            (F.col("o_totalprice") * 2).alias("total_claim_cost"),
        )

    def lines(self) -> DataFrame:
        # Sorted for the join in tasks of bounded size; the other side follows. Counting reads no column.
        l, o = self.raw("lineitem"), self.raw("orders").select("o_orderkey", F.col("o_custkey").alias("patient_id"))
        l = dealt(l, ["l_orderkey"], l.count())
        return l.join(o, l["l_orderkey"] == o["o_orderkey"]).withColumn("at", F.col("l_shipdate").cast("timestamp"))

    def line_condition(self) -> Column:
        return lookup(CONDITION_BY_FLAG, F.col("l_returnflag"))

    def line_lab(self) -> Column:
        return lookup(LAB_BY_LINE, F.col("l_linenumber"))

    def line_reading_id(self) -> Column:
        keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        return F.concat_ws("-", *keys, F.col("l_quantity").cast("bigint").cast("string"))

    def procedure(self) -> DataFrame:
        return self.lines().select("patient_id", F.col("at").alias("start_ts"))

    def medication(self) -> DataFrame:
        return self.lines().where("l_linestatus = 'F'").select(
            "patient_id", F.col("at").alias("start_ts")
        )

    def condition(self) -> DataFrame:
        return self.lines().where("l_linestatus = 'O'").select(
            "patient_id",
            F.to_date("at").alias("start_date"),
            self.line_condition().alias("code"),
        )

    def lab(self) -> DataFrame:
        """Readings from lines; a zero discount stands for a coded, non-numeric value."""
        return self.lines().select(
            self.line_reading_id().alias("observation_id"),
            "patient_id",
            F.col("at").alias("obs_date"),
            self.line_lab().alias("code"),
            F.when(F.col("l_discount") == 0, "coded").otherwise(F.col("l_quantity").cast("string")).alias("value"),
        )

    def patient(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        return self.raw("customer").select(
            key.alias("patient_id"),
            F.date_add(F.lit("1930-01-01").cast("date"), ((key * 37) % 22000).cast("int")).alias("birth_date"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_mktsegment").alias("race"),
            F.when(nation % 3 == 0, "hispanic").otherwise("nonhispanic").alias("ethnicity"),
        )

    def event(self) -> DataFrame:
        """Events as observations: one kind per code, some values not numeric."""
        return self.raw("events").select(
            F.col("event_id").alias("observation_id"),
            F.col("user_id").alias("patient_id"),
            F.col("event_type").alias("code"),
            F.col("ts").cast("timestamp").alias("obs_date"),
            F.when(F.col("event_id") % 13 == 0, "coded").otherwise(F.col("value").cast("string")).alias("value"),
        )

    def visit(self) -> DataFrame:
        return self.raw("events").where("event_type = 'purchase'").select(
            F.col("event_id").alias("visit_id"),
            F.col("user_id").alias("patient_id"),
            F.col("ts").cast("timestamp").alias("start_ts"),
        )

    # -- persons -------------------------------------------------------------------------------

    def person_a(self) -> DataFrame:
        k, n = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
        given = lambda i: F.element_at(F.array(*map(F.lit, GIVEN_NAMES)), (i + 1).cast("int"))
        family = lambda i: F.element_at(F.array(*map(F.lit, FAMILY_NAMES)), (i + 1).cast("int"))
        suffix = (k % 900 + 100).cast("string")
        first = given((k * 7 + n) % len(GIVEN_NAMES))
        last = family((k * 11 + n * 5) % len(FAMILY_NAMES))
        digits = F.lpad(((k * 7919 + 123456789) % 1000000000).cast("string"), 9, "0")
        ssn = F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4))
        zip_code = F.lpad((n * 1371 + 501 + k % 4).cast("string"), 5, "0")
        dob = F.date_add(F.lit("1940-01-01").cast("date"), ((k * 37) % 25000).cast("int")).cast("string")
        return self.raw("customer").select(
            k.cast("string").alias("patient_id"),
            dob.alias("dob"),
            F.when(k % 37 != 0, F.when(k % 4 == 0, F.concat(first, suffix)).otherwise(first)).alias("first"),
            F.when(k % 3 == 0, F.concat(last, suffix)).otherwise(last).alias("last"),
            F.when(k % 31 == 0, "").when(k % 29 != 0, ssn).alias("ssn"),
            F.when(k % 41 != 0, zip_code).alias("zip"),
        )

    # -- raw exports ---------------------------------------------------------------------------

    def exports(self, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
        """The seven raw text tables of an export, over whole source tables. Four of them are made from lines with their
        parts; `stage` may keep these where all are written."""
        text = lambda c: F.col(c).cast("string")
        iso = lambda c: F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        day = lambda c: F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd")
        o, p, s = self.raw("orders"), self.raw("part"), self.raw("supplier")
        nations = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        rows = self.raw("lineitem").count()
        both = dealt(self.lines(), ["l_partkey"], rows).join(p, F.col("l_partkey") == F.col("p_partkey"))
        numbers = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
        lines = stage(
            both.select(
                "patient_id", "l_orderkey", "l_partkey", *numbers, "l_returnflag", "l_linestatus", "l_shipdate", "p_name", "p_brand", "p_type"
            )
        )
        base = {
            "PATIENT": text("patient_id"),
            "ENCOUNTER": text("l_orderkey"),
            "CODE": text("l_partkey"),
            "DESCRIPTION": F.col("p_name"),
        }
        put = lambda df, **columns: df.select(*[c.alias(n) for n, c in columns.items()])
        nothing = F.lit(None).cast("string")
        # Parts of brands 1-5 are written under another spelling of the coding system.
        system = F.when(F.col("p_brand").isin(*[f"Brand#{i}" for i in range(1, 6)]), "SNOMED").otherwise("SNOMED-CT")
        dated = {"START": iso("l_shipdate"), "STOP": nothing}
        return {
            "patients": put(
                self.raw("customer").join(nations, "c_nationkey", "left"),
                Id=text("c_custkey"),
                BIRTHDATE=F.date_add(F.lit("1930-01-01").cast("date"), ((F.col("c_custkey") * 37) % 22000).cast("int")).cast(
                    "string"
                ),
                DEATHDATE=nothing,
                GENDER=F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M"),
                RACE=F.lower("c_mktsegment"),
                ETHNICITY=nothing,
                MARITAL=nothing,
                CITY=F.col("n_name"),
                STATE=F.col("n_name"),
                COUNTY=F.col("n_name"),
                ZIP=F.lpad(text("c_nationkey"), 5, "0"),
                LAT=text("c_acctbal"),
                LON=nothing,
            ),
            "organizations": put(
                s, Id=text("s_suppkey"), NAME=F.col("s_name"), CITY=nothing, STATE=text("s_nationkey"), ZIP=nothing
            ),
            "encounters": put(
                o,
                Id=text("o_orderkey"),
                PATIENT=text("o_custkey"),
                ORGANIZATION=text("o_custkey"),
                START=iso("o_orderdate"),
                STOP=F.when(F.col("o_orderstatus") == "F", iso("o_orderdate")),
                ENCOUNTERCLASS=F.lower("o_orderpriority"),
                CODE=F.substring("o_orderpriority", 1, 1),
                DESCRIPTION=F.col("o_orderpriority"),
                BASE_ENCOUNTER_COST=text("o_totalprice"),
                TOTAL_CLAIM_COST=text("o_totalprice"),
                PAYER_COVERAGE=F.lit("n.a."),
            ),
            "conditions": put(
                lines.where("l_linestatus = 'O'"), **(base | {"START": day("l_shipdate"), "STOP": nothing, "SYSTEM": system})
            ),
            "procedures": put(lines, **(base | dated | {"SYSTEM": system, "BASE_COST": text("l_extendedprice")})),
            "medications": put(
                lines.where("l_linestatus = 'F'"),
                **(
                    base
                    | dated
                    | {
                        "BASE_COST": text("l_extendedprice"),
                        "DISPENSES": F.col("l_quantity").cast("bigint").cast("string"),
                        "TOTALCOST": text("l_extendedprice"),
                    }
                ),
            ),
            "observations": put(
                lines,
                PATIENT=base["PATIENT"],
                ENCOUNTER=base["ENCOUNTER"],
                DATE=iso("l_shipdate"),
                CATEGORY=F.col("p_type"),
                CODE=lookup(LAB_BY_LINE, F.col("l_linenumber")),
                DESCRIPTION=F.col("p_brand"),
                VALUE=F.when(F.col("l_discount") == 0, "coded").otherwise(text("l_quantity")),
                UNITS=F.lower("l_returnflag"),
            ),
        }

    # -- evaluation and log --------------------------------------------------------------------

    def predictions(self) -> DataFrame:
        """Labelled documents with a score that has ties."""
        scored = self.raw("documents").select("doc_id", "lang", "n_chars")
        return self.raw("labels").join(scored, "doc_id").select(
            "doc_id",
            "lang",
            F.col("quality").alias("label"),
            F.col("n_chars"),
            ((F.col("n_chars") % 101) / F.lit(100.0)).alias("score"),
        )

    def log(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("kind"),
            F.col("props").alias("input_summary"),
            (F.col("value") / F.lit(500.0)).alias("score"),
            F.col("ts").cast("timestamp").alias("created_at"),
        )


def lookup(values: dict, key: Column) -> Column:
    """A fixed mapping as a constant map."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


# -- the same views as SQL ---------------------------------------------------------------------


def _sql_case(values: dict, column: str) -> str:
    return "CASE " + column + "".join(f" WHEN {k!r} THEN {v!r}" for k, v in values.items()) + " END"


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def sql_views() -> dict[str, str]:
    """View name -> SELECT over the supplied tables."""
    lines = "lineitem JOIN orders ON l_orderkey = o_orderkey"
    k, n = "c_custkey", "c_nationkey"
    first = f"{_sql_list(GIVEN_NAMES)}[(({k} * 7 + {n}) % {len(GIVEN_NAMES)}) + 1]"
    last = f"{_sql_list(FAMILY_NAMES)}[(({k} * 11 + {n} * 5) % {len(FAMILY_NAMES)}) + 1]"
    digits = f"lpad(CAST(({k} * 7919 + 123456789) % 1000000000 AS VARCHAR), 9, '0')"
    suffix = f"CAST({k} % 900 + 100 AS VARCHAR)"
    return {
        "v_encounter": """
            SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_orderdate AS start_ts,
              CASE WHEN o_orderkey % 50 <> 0
                THEN o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) END AS stop_ts,
              CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'inpatient' ELSE 'ambulatory' END
                AS encounter_class,
              o_totalprice AS base_cost, o_totalprice * 2 AS total_claim_cost
            FROM orders""",
        "v_stay": "SELECT * FROM v_encounter WHERE encounter_class = 'inpatient' AND stop_ts IS NOT NULL",
        "v_procedure": f"SELECT o_custkey AS patient_id, l_shipdate AS start_ts FROM {lines}",
        "v_medication": f"SELECT o_custkey AS patient_id, l_shipdate AS start_ts FROM {lines} WHERE l_linestatus = 'F'",
        "v_condition": f"""
            SELECT o_custkey AS patient_id, CAST(l_shipdate AS DATE) AS start_date,
              {_sql_case(CONDITION_BY_FLAG, "l_returnflag")} AS code
            FROM {lines} WHERE l_linestatus = 'O'""",
        "v_lab": f"""
            SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT))
                AS observation_id,
              o_custkey AS patient_id, l_shipdate AS obs_date,
              {_sql_case(LAB_BY_LINE, "l_linenumber")} AS code,
              CASE WHEN l_discount = 0 THEN 'coded' ELSE CAST(l_quantity AS VARCHAR) END AS value
            FROM {lines}""",
        "v_patient": f"""
            SELECT {k} AS patient_id, DATE '1930-01-01' + CAST(({k} * 37) % 22000 AS INTEGER) AS birth_date,
              CASE WHEN {k} % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS race,
              CASE WHEN {n} % 3 = 0 THEN 'hispanic' ELSE 'nonhispanic' END AS ethnicity
            FROM customer""",
        "v_event": """
            SELECT event_id AS observation_id, user_id AS patient_id, event_type AS code, ts AS obs_date,
              CASE WHEN event_id % 13 = 0 THEN 'coded' ELSE CAST(value AS VARCHAR) END AS value
            FROM events""",
        "v_visit": """
            SELECT event_id AS visit_id, user_id AS patient_id, ts AS start_ts
            FROM events WHERE event_type = 'purchase'""",
        "v_person_a": f"""
            SELECT CAST({k} AS VARCHAR) AS patient_id,
              CAST(DATE '1940-01-01' + CAST(({k} * 37) % 25000 AS INTEGER) AS VARCHAR) AS dob,
              CASE WHEN {k} % 37 <> 0 THEN {first} || CASE WHEN {k} % 4 = 0 THEN {suffix} ELSE '' END END AS first,
              {last} || CASE WHEN {k} % 3 = 0 THEN {suffix} ELSE '' END AS last,
              CASE WHEN {k} % 31 = 0 THEN ''
                WHEN {k} % 29 <> 0 THEN concat_ws('-', substr({digits}, 1, 3), substr({digits}, 4, 2),
                  substr({digits}, 6, 4)) END AS ssn,
              CASE WHEN {k} % 41 <> 0
                THEN lpad(CAST({n} * 1371 + 501 + {k} % 4 AS VARCHAR), 5, '0') END AS zip
            FROM customer""",
        "v_raw_code": f"""
            SELECT CASE WHEN p_brand IN ({', '.join(f"'Brand#{i}'" for i in range(1, 6))})
                THEN 'SNOMED' ELSE 'SNOMED-CT' END AS code_system, CAST(l_partkey AS VARCHAR) AS code,
              p_name AS description, CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS rank
            FROM {lines} JOIN part ON l_partkey = p_partkey
            UNION ALL SELECT 'SNOMED-CT', o_orderpriority[1], o_orderpriority, 2 FROM orders
            UNION ALL SELECT 'RxNorm', CAST(l_partkey AS VARCHAR), p_name, 3
            FROM {lines} JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F'
            UNION ALL SELECT 'LOINC', {_sql_case(LAB_BY_LINE, "l_linenumber")}, p_brand, 4
            FROM {lines} JOIN part ON l_partkey = p_partkey""",
        "v_pred": """
            SELECT labels.doc_id, lang, quality AS label, n_chars, (n_chars % 101) / 100.0::DOUBLE AS score
            FROM labels JOIN documents USING (doc_id)""",
        "v_log": """
            SELECT event_id AS id, event_type AS kind, props AS input_summary, value / 500.0::DOUBLE AS score,
              ts AS created_at
            FROM events""",
    }
