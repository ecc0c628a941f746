"""Input relations: the demo view, the unit fixture, and workloads derived from the given tables.

Every derived workload has a Spark builder (DataFrame API) and a DuckDB SQL twin that
gives the same rows, used by the SQL cross-checks.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Comparison, Model
from .tables import read_table

# --- fixed values: the demo relation and unit fixture ----------------------
# (record_id, first_name, last_name, email, city, expected_entity)
SAMPLE_CUSTOMERS = [
    (1, "John", "Smith", "jsmith@example.com", "New York", "Smith, John"),
    (2, "Jon", "Smith", "jsmith@example.com", "New York", "Smith, John"),
    (3, "Johnny", "Smith", "jsmith@example.com", "New York", "Smith, John"),
    (4, "Jane", "Doe", "jane.doe@example.com", "Los Angeles", "Doe, Jane"),
    (5, "Janet", "Doe", "jane.doe@example.com", "Los Angeles", "Doe, Jane"),
    (6, "Robert", "Jones", "rjones@example.com", "San Francisco", "Jones, Robert"),
    (7, "Alice", "Jones", "alice.j@example.com", "Seattle", "Jones, Alice"),
]
# Ground-truth partition of the unit fixture by row_id (0-based).
CUSTOMER_GROUPS = [[0, 1, 2], [3, 4], [5], [6]]
COMPARISON_COLUMNS = ["first_name", "last_name", "email"]
# Inline relations (first_name, last_name, email).
THREE = [("John", "Smith", "john@x.com"), ("Jon", "Smith", "john@x.com"), ("Jane", "Doe", "jane@y.com")]
ANN = [("Ann", "Lee", "ann@z.com"), ("Anne", "Lee", "ann@z.com"), ("Bob", "Ng", "bob@z.com")]
FIVE = THREE + [("Jayne", "Doe", "jane@y.com"), ("Bob", "Ng", "bob@z.com")]
# --- end of fixed values -----------------------------------------------------

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.IntegerType(), False),
        T.StructField("first_name", T.StringType(), True),
        T.StructField("last_name", T.StringType(), True),
        T.StructField("email", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("expected_entity", T.StringType(), True),
    ]
)


def sample_customers(spark: SparkSession, register: bool = True) -> DataFrame:
    """The 7-row demo relation with a ground-truth label; registered as view ``sample_customers``."""
    df = spark.createDataFrame(SAMPLE_CUSTOMERS, SAMPLE_SCHEMA)
    if register:
        df.createOrReplaceTempView("sample_customers")
    return df


def customers(spark: SparkSession) -> DataFrame:
    """The unit fixture: ``row_id`` 0..6 and the demo rows without the label."""
    rows = [(i, fn, ln, em, city) for i, (_, fn, ln, em, city, _) in enumerate(SAMPLE_CUSTOMERS)]
    return spark.createDataFrame(rows, "row_id bigint, first_name string, last_name string, email string, city string")


def inline(spark: SparkSession, rows: list[tuple], cols: str = "first_name string, last_name string, email string"):
    return spark.createDataFrame(rows, cols)


# --- planted customers (from customer) ---------------------------------------


def planted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with planted near-copies and the true entity (``expected_entity``).

    Every customer k appears once; k % 5 == 0 adds a copy with a changed last letter of the
    first name; k % 7 == 0 adds a copy with a longer surname and a shortened (k % 14 == 0:
    missing) email. Surnames repeat every 997 customers.
    """
    b = read_table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS k",
        "substr(md5(concat('f', CAST(c_custkey AS STRING))), 1, 6) AS f",
        "substr(md5(concat('l', CAST(c_custkey % 997 AS STRING))), 1, 7) AS l",
        "concat(substr(md5(concat('e', CAST(c_custkey AS STRING))), 1, 8), '@', lower(c_mktsegment), '.example') AS e",
    )
    base = b.selectExpr("k * 3 AS record_id", "f AS first_name", "l AS last_name", "e AS email", "k AS expected_entity")
    typo = b.where("k % 5 = 0").selectExpr(
        "k * 3 + 1 AS record_id", "concat(substr(f, 1, 5), 'z') AS first_name", "l AS last_name", "e AS email",
        "k AS expected_entity",
    )
    moved = b.where("k % 7 = 0").selectExpr(
        "k * 3 + 2 AS record_id", "f AS first_name", "concat(l, 'q') AS last_name",
        "CASE WHEN k % 14 = 0 THEN CAST(NULL AS STRING) ELSE substr(e, 2) END AS email", "k AS expected_entity",
    )
    return base.unionByName(typo).unionByName(moved)


PLANTED_CUSTOMERS_SQL = """
WITH b AS (
  SELECT CAST(c_custkey AS BIGINT) AS k,
         substr(md5(concat('f', CAST(c_custkey AS VARCHAR))), 1, 6) AS f,
         substr(md5(concat('l', CAST(c_custkey % 997 AS VARCHAR))), 1, 7) AS l,
         concat(substr(md5(concat('e', CAST(c_custkey AS VARCHAR))), 1, 8), '@', lower(c_mktsegment), '.example') AS e
  FROM customer)
SELECT k*3 AS record_id, f AS first_name, l AS last_name, e AS email, k AS expected_entity FROM b
UNION ALL SELECT k*3+1, concat(substr(f, 1, 5), 'z'), l, e, k FROM b WHERE k % 5 = 0
UNION ALL SELECT k*3+2, f, concat(l, 'q'), CASE WHEN k % 14 = 0 THEN NULL ELSE substr(e, 2) END, k
          FROM b WHERE k % 7 = 0
"""

# --- documents (whole texts) ---------------------------------------------------


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with language, source and length: exact copies and texts a few edits apart, non-ASCII text."""
    return read_table(spark, sf_dir, "documents").selectExpr(
        "CAST(doc_id AS BIGINT) AS doc_id", "text", "lang", "source", "CAST(n_chars AS STRING) AS n_chars"
    )


DOCUMENT_TEXTS_SQL = """
SELECT CAST(doc_id AS BIGINT) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents
"""



def edited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents and, of those of up to 3,000 characters, copies a few edits away: a letter put into the middle of every third, two characters taken out
    of every fifth (not next to each other), the first replaced and one added at the end of every seventh. Ids are four times the document's, and 1 to 3 more for the copies."""
    d = document_texts(spark, sf_dir).where("text IS NOT NULL")
    long = d.where("length(text) BETWEEN 6 AND 3000").withColumn("h", F.expr("length(text) div 2"))
    copies = [
        ("doc_id % 3 = 0", 1, "concat(substr(text, 1, h), 'q', substr(text, h + 1))"),
        ("doc_id % 5 = 0", 2, "concat(substr(text, 2, h - 1), substr(text, h + 2))"),
        ("doc_id % 7 = 0", 3, "concat('Z', substr(text, 2), '!')"),
    ]
    out = d.selectExpr("doc_id * 4 AS doc_id", "text", "lang", "source", "n_chars")
    for which, k, text in copies:
        made = long.where(which).selectExpr(f"doc_id * 4 + {k} AS doc_id", f"{text} AS text", "lang", "source")
        out = out.unionByName(made.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS STRING) AS n_chars"))
    return out


EDITED_DOCUMENTS_SQL = f"""
WITH d AS (SELECT *, CAST(length(text) // 2 AS INTEGER) AS h FROM ({DOCUMENT_TEXTS_SQL}) WHERE text IS NOT NULL),
made AS (
  SELECT doc_id * 4 + 1 AS doc_id, concat(substr(text, 1, h), 'q', substr(text, h + 1)) AS text, lang, source FROM d WHERE doc_id % 3 = 0 AND length(text) BETWEEN 6 AND 3000
  UNION ALL SELECT doc_id * 4 + 2, concat(substr(text, 2, h - 1), substr(text, h + 2)), lang, source FROM d WHERE doc_id % 5 = 0 AND length(text) BETWEEN 6 AND 3000
  UNION ALL SELECT doc_id * 4 + 3, concat('Z', substr(text, 2), '!'), lang, source FROM d WHERE doc_id % 7 = 0 AND length(text) BETWEEN 6 AND 3000)
SELECT doc_id * 4 AS doc_id, text, lang, source, n_chars FROM d
UNION ALL SELECT doc_id, text, lang, source, CAST(length(text) AS VARCHAR) FROM made
"""

# A model for them: whole texts by edit distance, pairs from texts that are equal or at most two edits apart. Fixed values.
DOCUMENT_MODEL = Model(
    0.001,
    (
        Comparison("text", "edit", (1.0, 2.0), (0.02, 0.03, 0.05, 0.9), (0.9999, 0.00004, 0.00004, 0.00002)),
        Comparison("lang", "edit", (1.0, 2.0), (0.02, 0.01, 0.01, 0.96), (0.5, 0.05, 0.05, 0.4)),
        Comparison("source", "edit", (1.0, 2.0), (0.5, 0.1, 0.1, 0.3), (0.7, 0.15, 0.1, 0.05)),
        Comparison("n_chars", "edit", (1.0, 2.0), (0.05, 0.1, 0.15, 0.7), (0.8, 0.1, 0.095, 0.005)),
    ),
    blocking=(("text",),),
    near=(("text", 2),),
)

# --- part attributes (from part) ----------------------------------------------


def part_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts on name, brand and type: low-cardinality columns that chain into one entity."""
    return read_table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS BIGINT) AS p_partkey", "p_name AS name", "p_brand", "p_type"
    )


PART_ATTRIBUTES_SQL = """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name AS name, p_brand, p_type FROM part
"""

# Composite rules keep the candidate pairs of such columns few.
PART_BLOCKING = (("name", "p_brand"), ("name", "p_type"), ("p_brand", "p_type"))

# --- new customer records (from customer), to score against planted customers ----


def new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new record per customer with a changed last letter of the first name (true entity kept)."""
    return as_new_customers(read_table(spark, sf_dir, "customer"))


def as_new_customers(customer: DataFrame) -> DataFrame:
    """:func:`new_customers` of any customer table, a stream too."""
    return customer.selectExpr(
        "CAST(c_custkey AS BIGINT) AS new_id",
        "concat(substr(md5(concat('f', CAST(c_custkey AS STRING))), 1, 5), 'y') AS first_name",
        "substr(md5(concat('l', CAST(c_custkey % 997 AS STRING))), 1, 7) AS last_name",
        "concat(substr(md5(concat('e', CAST(c_custkey AS STRING))), 1, 8), '@', lower(c_mktsegment), '.example') AS email",
        "CAST(c_custkey AS BIGINT) AS expected_entity",
    )


NEW_CUSTOMERS_SQL = """
SELECT CAST(c_custkey AS BIGINT) AS new_id,
       concat(substr(md5(concat('f', CAST(c_custkey AS VARCHAR))), 1, 5), 'y') AS first_name,
       substr(md5(concat('l', CAST(c_custkey % 997 AS VARCHAR))), 1, 7) AS last_name,
       concat(substr(md5(concat('e', CAST(c_custkey AS VARCHAR))), 1, 8), '@', lower(c_mktsegment), '.example') AS email,
       CAST(c_custkey AS BIGINT) AS expected_entity
FROM customer
"""

# Workloads: name -> (builder, duckdb sql, id column, model)
WORKLOADS = {
    "planted": (planted_customers, PLANTED_CUSTOMERS_SQL, "record_id", Model.default(["first_name", "last_name", "email"])),
    "documents": (document_texts, DOCUMENT_TEXTS_SQL, "doc_id", DOCUMENT_MODEL),
    "edited": (edited_documents, EDITED_DOCUMENTS_SQL, "doc_id", DOCUMENT_MODEL),
    "parts": (part_attributes, PART_ATTRIBUTES_SQL, "p_partkey", replace(Model.default(["name", "p_brand", "p_type"]), blocking=PART_BLOCKING)),
}
