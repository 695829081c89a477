"""Queries on single records: names, places, boxes, formats, codes and upserts, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records, text
from ..operators import relational
from ..sources import readers
from .registry import query, table


@query("""
SELECT o_orderkey, 'sn' || CAST(o_custkey AS VARCHAR) AS newspaper_id, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 7 AS VARCHAR), 2, '0') AS edition_slug,
  CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(day(o_orderdate) AS INT) AS day, CAST(o_orderkey % 7 AS INT) AS edition_number FROM orders""")
def archive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of archives' names, an order each."""
    slug = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad((F.col("o_orderkey") % 7).cast("string"), 2, "0"))
    name = F.concat(F.lit("sn"), F.col("o_custkey").cast("string"), F.lit("_"), slug, F.lit(".tar.gz"))
    return table(spark, sf_dir, "orders").select("o_orderkey", records.archive_fields(name).alias("x")).select("o_orderkey", "x.*")


@query("""
WITH l AS (SELECT p_partkey AS line, CAST(p_size AS VARCHAR) AS category, [lower(split_part(p_name, ' ', 1)), upper(split_part(p_name, ' ', 2)), p_brand] AS terms FROM part),
t AS (SELECT line, category, lower(unnest(terms)) AS term, generate_subscripts(terms, 1) AS pos FROM l)
SELECT term, arg_max(category, (line, pos)) AS category FROM t GROUP BY 1""")
def thesaurus_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of a thesaurus of JSON lines, a part each; of a term given twice the last category."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    line = F.struct(F.col("p_size").cast("string").alias("category"), F.lower(word(1)).alias("keyword"), F.array(F.upper(word(2)), "p_brand").alias("related_terms"))
    return readers.thesaurus(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line"), F.to_json(line).alias("value")))


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey + 10, 'new ' || c_name FROM customer WHERE c_custkey % 3 = 0
EXCEPT ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 AND (c_custkey - 10) IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)""")
def upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, some of them replaced."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    new = rows.filter("c_custkey % 3 = 0").select((F.col("c_custkey") + 10).alias("c_custkey"), F.concat(F.lit("new "), F.col("c_name")).alias("c_name"))
    return relational.upserted(rows.filter("c_custkey % 3 != 0"), new, "c_custkey")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_KEYS = [c.strip() for c in _LINE.split(",")]
_SIDES = "l_linenumber * 8.0 AS a, l_partkey % 30 * 1.0 AS b, l_quantity AS c, l_suppkey % 40 * 1.0 AS d"


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as boxes, some of them turned around."""
    return table(spark, sf_dir, "lineitem").select(*_KEYS, F.array((F.col("l_linenumber") * 8).cast("double"), (F.col("l_partkey") % 30).cast("double"), F.col("l_quantity").cast("double"), (F.col("l_suppkey") % 40).cast("double")).alias("box"))


@query(f"SELECT {_LINE}, CASE WHEN (c - a) * (d - b) > 0 THEN CAST((c - a) * (d - b) AS DOUBLE) END AS area FROM (SELECT {_LINE}, {_SIDES} FROM lineitem)")
def crop_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sides(spark, sf_dir).select(*_KEYS, records.box_area(F.col("box")).alias("area"))


@query(f"""
WITH s AS (SELECT {_LINE}, CAST(l_linenumber * 400 AS DOUBLE) AS w, CAST(500 + l_partkey % 3000 AS DOUBLE) AS h, CAST(l_quantity * 18 AS DOUBLE) AS x FROM lineitem),
r AS (SELECT *, least(960 / h, 960 / w) AS r FROM s),
p AS (SELECT *, (960 - round_even(w * r, 0)) / 2 AS px, (960 - round_even(h * r, 0)) / 2 AS py FROM r)
SELECT {_LINE}, greatest(0.0, least((x - px) / r, w)) AS lo, greatest(0.0, least((x + 90 - py) / r, h)) AS hi FROM p""")
def letterbox_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners found in a square model input, in the pixels of an image."""
    x = (F.col("l_quantity") * 18).cast("double")
    box = records.from_letterbox(F.array(x, x + 90, x, x), (F.col("l_linenumber") * 400).cast("double"), (500 + F.col("l_partkey") % 3000).cast("double"))
    return table(spark, sf_dir, "lineitem").select(*_KEYS, box[0].alias("lo"), box[1].alias("hi"))


@query("""
WITH s AS (SELECT p_partkey, CAST(p_size * 250 AS DOUBLE) AS w, CAST(300 + p_partkey % 9000 AS DOUBLE) AS h FROM part),
k AS (SELECT *, least(1.0::DOUBLE, sqrt(4000000.0::DOUBLE / (w * h))) AS k FROM s)
SELECT p_partkey, (CAST(w * h AS BIGINT) + 50) // 100 / 10000.0::DOUBLE AS megapixels, (CAST(floor(w * k) * floor(h * k) AS BIGINT) + 50) // 100 / 10000.0::DOUBLE AS within FROM k""")
def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Million pixels of images, halves up, and those within a budget of four."""
    w, h = (F.col("p_size") * 250).cast("double"), (300 + F.col("p_partkey") % 9000).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", records.megapixels(w, h).alias("megapixels"), records.megapixels(w, h, 4e6).alias("within"))


@query("""
SELECT n_nationkey, CASE lower(trim(n_name)) WHEN 'france' THEN 'FRA' WHEN 'germany' THEN 'DEU' ELSE upper(trim(n_name))[1:3] END AS country,
  CASE WHEN n_nationkey % 3 = 0 THEN n_name WHEN n_nationkey % 3 = 1 THEN 'second' ELSE '' END AS earliest FROM nation""")
def place_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries by code, and the one of several values that a list of places has first."""
    place = F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit("x"), F.lower("n_name"), F.lit("second"))).when(F.col("n_nationkey") % 3 == 1, F.array(F.lit("second")))
    values = F.when(F.col("n_nationkey") % 3 == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("second"), F.col("n_name")))
    country = records.place_code(F.concat(F.lit(" "), F.col("n_name")), {"france": "FRA", "germany": "DEU"}, 3)
    return table(spark, sf_dir, "nation").select("n_nationkey", country.alias("country"), records.earliest_in(values, F.coalesce(place, F.array().cast("array<string>"))).alias("earliest"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(year(o_orderdate) AS INT) END AS year_start, CASE WHEN o_orderkey % 4 = 1 THEN CAST(year(o_orderdate) + o_orderkey % 9 AS INT) END AS year_end FROM orders""")
def publication_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years from texts like "1994-1999", "1994-19??", "1994-" and "1994"."""
    year, left = F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 4
    later = (F.year("o_orderdate") + F.col("o_orderkey") % 9).cast("string")
    given = F.when(left == 0, year).when(left == 1, F.concat(year, F.lit(" - "), later)).when(left == 2, F.concat(year, F.lit("-19??"))).otherwise(F.concat(year, F.lit("-")))
    return table(spark, sf_dir, "orders").select("o_orderkey", records.year_range(given).alias("y")).select("o_orderkey", "y.*")


@query("""
SELECT event_id, 'scan__' || CAST(user_id AS VARCHAR) || '__' || event_type AS key, CAST(device AS VARCHAR) AS device, CAST(event_id % 1000 / 10.0 + device AS DOUBLE) AS percent
FROM events, (SELECT unnest([0, 1]) AS device) WHERE device = 0 OR event_id % 5 <> 0""")
def device_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads by device from texts like "0:45.2,1:46.2", and keys of caches."""
    load = (F.col("event_id") % 1000 / 10).cast("double")
    given = F.concat(F.lit("0:"), load.cast("string"), F.when(F.col("event_id") % 5 == 0, ",1:,junk").otherwise(F.concat(F.lit(",1:"), (load + 1).cast("string"))))
    key = records.cache_key(F.lit("scan"), F.col("user_id").cast("string"), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", key.alias("key"), F.explode(records.per_device(given)).alias("device", "percent"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'other-thing' ELSE 'step' || lpad(CAST(o_orderkey % 16 AS VARCHAR), 2, '0') || '-crop-it' END AS step,
  CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE CAST(o_orderkey % 16 AS INT) END AS number,
  CASE WHEN s >= 3600 THEN s // 3600 || 'h ' || s // 60 % 60 || 'm ' || s % 60 || 's' WHEN s >= 60 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s || 's' END AS took
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 9000 AS s FROM orders)""")
def step_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and numbers of steps, and how long they took, in words."""
    name = F.when(F.col("o_orderkey") % 6 == 0, "other_thing").otherwise(F.concat(F.lit("step"), F.lpad((F.col("o_orderkey") % 16).cast("string"), 2, "0"), F.lit("_crop_it")))
    step = records.step_name(name)
    return table(spark, sf_dir, "orders").select("o_orderkey", step.alias("step"), records.step_number(step).alias("number"), records.seconds_text(F.floor("o_totalprice") % 9000).alias("took"))


@query("""
WITH s AS (SELECT user_id, CASE WHEN user_id % 4 = 0 THEN 'completed' WHEN user_id % 4 = 1 THEN 'pending' WHEN event_id % 97 = 0 THEN 'crashed' WHEN event_id % 13 = 0 AND user_id % 4 = 2 THEN 'running'
  WHEN event_id % 2 = 0 THEN 'completed' ELSE 'pending' END AS s FROM events)
SELECT user_id, CASE WHEN bool_or(s = 'crashed') THEN 'crashed' WHEN bool_or(s = 'running') THEN 'running' WHEN bool_and(s = 'completed') THEN 'completed' WHEN bool_and(s = 'pending') THEN 'pending' ELSE 'running' END AS status
FROM s GROUP BY 1""")
def overall_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of runs, a user each, by those of their batches."""
    user, event = F.col("user_id") % 4, F.col("event_id")
    status = (
        F.when(user == 0, "completed").when(user == 1, "pending").when(event % 97 == 0, "crashed").when((event % 13 == 0) & (user == 2), "running")
        .when(event % 2 == 0, "completed").otherwise("pending")
    )
    return table(spark, sf_dir, "events").groupBy("user_id").agg(records.overall_status(status).alias("status"))


@query("""
SELECT doc_id, CASE upper(lang) WHEN 'EN' THEN 'eng' WHEN 'FR' THEN 'fra' ELSE 'und' END AS known,
  CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN lang = 'de' THEN 'de' WHEN lang = 'fr' THEN 'fr' WHEN lang = 'es' THEN 'es' ELSE 'en' END AS short,
  replace(replace(replace(replace(replace(substr(text, 1, 200), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped FROM documents""")
def codes_and_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of languages, short or known, and the beginnings of texts with their markup escaped."""
    three = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("lang") == "en", "eng").when(F.col("lang") == "de", "DEU").when(F.col("lang") == "fr", "fra").otherwise("Spa")
    code = F.when(F.col("lang") == "en", "eng").when(F.col("lang") == "fr", "fra").otherwise("xxx")
    return table(spark, sf_dir, "documents").select(
        "doc_id", records.known_or(code, F.array(F.lit("eng"), F.lit("fra")), "und").alias("known"), records.short_language(three).alias("short"),
        records.escape_markup(F.substring("text", 1, 200)).alias("escaped"),
    )


@query(r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(substr(text, 1, 3500), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(CASE WHEN len(w) > 0 THEN range(0, len(w), 400) ELSE [] END) AS i FROM w)
SELECT doc_id, i // 400 AS piece, array_to_string(w[i + 1:i + 400], ' ') AS words FROM p""")
def guarded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model with short input is given of each text, piece by piece."""
    found = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.guarded_pieces(F.col("text"))).alias("piece", "words"))
    return found.select("doc_id", F.col("piece").cast("long").alias("piece"), "words")
