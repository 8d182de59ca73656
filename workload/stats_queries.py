"""Statistics, trend, cleaning and feature queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldmosaic.operators import clean, resilience, stats
from fieldmosaic.plans.training import TrainingPlan, run
from fieldmosaic.runtime import checkpoint_folder
from fieldmosaic.sources.sinks import export_training_set
from fieldmosaic.sources.tables import latest_output as newest_output
from fieldmosaic.sources.tables import load_statistics
from workload.inputs import DEPENDS, INPUTS, county_id, ctes, load, town_id
from workload.registry import query

INPUTS["town_list"] = f"SELECT {town_id('s_suppkey')} AS town_id, {county_id('s_suppkey')} AS county_id, CAST(s_suppkey % 9 AS DOUBLE) AS weight, s_acctbal AS soil FROM supplier"
INPUTS["town_signals"] = "SELECT town_id, year, rain_total, heat_days, storm_distance FROM signals"
INPUTS["out_paths"] = """
SELECT CASE WHEN doc_id % 9 = 4 THEN 'output/readme_' || CAST(doc_id AS STRING) || '.txt' ELSE
  'output/GIS_processed_' || source || '_' || lang || '_2024' || lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0') || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') ||
  CASE WHEN doc_id % 2 = 0 THEN '.csv' ELSE '.parquet' END END AS path
FROM documents"""
INPUTS["area_pixels"] = f"SELECT CASE WHEN l_suppkey % 10 = 3 THEN 'new ' ELSE '' END || {town_id('l_suppkey')} AS area_id, count(*) AS n_pixels, avg(l_discount) AS cover FROM lineitem GROUP BY l_suppkey"
INPUTS["town_stats"] = "SELECT CASE WHEN town_id = 'A00' THEN 'old A00' ELSE town_id END AS town_id, year, quantity FROM stats"
INPUTS["yield_features"] = """
SELECT s.town_id, s.county_id, s.year, s.rain_total, s.heat_days, y.yield AS target
FROM signals s, yields y WHERE s.county_id = y.county_id AND s.year = y.year"""
DEPENDS.update({"town_signals": ["signals"], "town_stats": ["stats"], "yield_features": ["signals", "yields"]})


@query("stats_load", "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY c_mktsegment")
def stats_load(spark, sf_dir):
    loaded = load_statistics(spark, sf_dir, "customer")
    return loaded.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query("summarize_stats", ctes("stats") + """SELECT town_id, item, sum(quantity) AS quantity_sum, round(avg(quantity), 6) AS quantity_mean, max(quantity) AS quantity_max,
  quantile_cont(quantity, 0.5) AS quantity_median FROM stats GROUP BY town_id, item""")
def summarize_stats(spark, sf_dir):
    out = stats.summarize(load(spark, sf_dir, "stats"), ["town_id", "item"], {"quantity": ["sum", "mean", "max", "median"]})
    return out.withColumn("quantity_mean", F.round("quantity_mean", 6))


@query("summarize_yearly", ctes("stats") + """SELECT town_id, round(avg(total), 6) AS quantity_yearly_mean, count(*) AS n_years FROM (
  SELECT town_id, year, sum(quantity) AS total FROM stats GROUP BY town_id, year) y GROUP BY town_id""")
def summarize_yearly(spark, sf_dir):
    out = stats.yearly_mean(load(spark, sf_dir, "stats"), ["town_id"], "year", "quantity")
    return out.withColumn("quantity_yearly_mean", F.round("quantity_yearly_mean", 6))


@query("summarize_recent_n", ctes("stats") + """SELECT town_id, year, quantity, rn AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY town_id ORDER BY year DESC) AS rn FROM (SELECT town_id, year, sum(quantity) AS quantity FROM stats GROUP BY town_id, year) y) r WHERE rn <= 3""")
def summarize_recent_n(spark, sf_dir):
    out = stats.recent_years(load(spark, sf_dir, "stats"), ["town_id"], "year", "quantity", 3)
    return out.withColumn("recency", F.col("recency").cast("long"))


@query("summarize_groups", ctes("stats") + """SELECT town_id, sum(CASE WHEN item_group = 'F' THEN quantity ELSE 0 END) AS quantity_F,
  sum(CASE WHEN item_group = 'O' THEN quantity ELSE 0 END) AS quantity_O FROM stats GROUP BY town_id""")
def summarize_groups(spark, sf_dir):
    return stats.pivot_groups(load(spark, sf_dir, "stats"), ["town_id"], "item_group", "quantity", ["F", "O"])


@query("join_gis_stats", ctes("area_pixels", "stats") + """SELECT area_id, n_pixels, round(cover, 6) AS cover, quantity_sum FROM area_pixels
  LEFT JOIN (SELECT town_id, sum(quantity) AS quantity_sum FROM stats GROUP BY town_id) s ON area_id = town_id""")
def join_gis_stats(spark, sf_dir):
    features = load(spark, sf_dir, "area_pixels").withColumn("cover", F.round("cover", 6))
    return stats.join_features(features, stats.summarize(load(spark, sf_dir, "stats"), ["town_id"], {"quantity": "sum"}), "town")


@query("align_targets", ctes("yields", "town_list", "town_signals") + """SELECT w.town_id, w.county_id, w.year, s.rain_total, y.yield FROM (
  SELECT t.town_id, t.county_id, CAST(s.year AS INT) AS year FROM town_list t JOIN town_signals s USING (town_id)
  UNION SELECT t.town_id, t.county_id, CAST(y.year AS INT) FROM town_list t JOIN yields y USING (county_id)) w
  LEFT JOIN town_signals s ON s.town_id = w.town_id AND s.year = w.year LEFT JOIN yields y ON y.county_id = w.county_id AND y.year = w.year""")
def align_targets(spark, sf_dir):
    towns = load(spark, sf_dir, "town_list").select("town_id", "county_id")
    signals = load(spark, sf_dir, "town_signals").select("town_id", F.col("year").cast("int").alias("year"), "rain_total")
    return resilience.align_targets(load(spark, sf_dir, "yields"), towns, signals).select("town_id", "county_id", "year", "rain_total", "yield")


TREND = "SELECT *, avg(yield) OVER (PARTITION BY county_id ORDER BY year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS trend FROM yields"


@query("detrend_moving_avg", ctes("yields", t=TREND) + "SELECT county_id, year, yield, round(trend, 6) AS trend FROM t")
def detrend_moving_avg(spark, sf_dir):
    out = stats.moving_trend(load(spark, sf_dir, "yields"), "county_id", "year", "yield")
    return out.select("county_id", "year", "yield", F.round("trend", 6).alias("trend"))


@query("yield_deviation", ctes("yields", t=TREND) + "SELECT county_id, year, round((yield - trend) / nullif(trend, 0), 6) AS deviation FROM t")
def yield_deviation(spark, sf_dir):
    out = stats.moving_trend(load(spark, sf_dir, "yields"), "county_id", "year", "yield")
    return out.select("county_id", "year", F.round("deviation", 6).alias("deviation"))


# The same five bands, row by row: `fw` eliminates downwards, `bw` substitutes upwards; each carries the row next to it.
BANDS = """SELECT county_id, year, yield, i, n, 1 + first + 4 * middle + CASE WHEN i >= 2 THEN 100 ELSE 0 END AS a, -2 * (first + middle) AS b, first AS c FROM (
  SELECT *, CASE WHEN i <= n - 3 THEN 100.0::DOUBLE ELSE 0 END AS first, CASE WHEN i >= 1 AND i <= n - 2 THEN 100.0::DOUBLE ELSE 0 END AS middle FROM (
    SELECT *, row_number() OVER (PARTITION BY county_id ORDER BY year) - 1 AS i, count(*) OVER (PARTITION BY county_id) AS n FROM yields) y) p"""
FORWARD = """SELECT county_id, year, yield, i, n, a AS d, b / a AS e, c / a AS f, yield AS z, 0.0::DOUBLE AS d1, 0.0::DOUBLE AS f1, 0.0::DOUBLE AS z1 FROM bands WHERE i = 0
  UNION ALL SELECT county_id, year, yield, i, n, d, (b - pd * pe * pf) / d, c / d, z, pd, pf, pz FROM (
    SELECT b.*, w.d AS pd, w.e AS pe, w.f AS pf, w.z AS pz, b.a - w.d * w.e * w.e - w.d1 * w.f1 * w.f1 AS d, b.yield - w.e * w.z - w.f1 * w.z1 AS z
    FROM fw w JOIN bands b ON b.county_id = w.county_id AND b.i = w.i + 1) s"""
BACKWARD = """SELECT county_id, year, yield, i, z / d AS x, 0.0::DOUBLE AS x1 FROM fw WHERE i = n - 1
  UNION ALL SELECT f.county_id, f.year, f.yield, f.i, f.z / f.d - f.e * t.x - f.f * t.x1, t.x FROM bw t JOIN fw f ON f.county_id = t.county_id AND f.i = t.i - 1"""


@query("detrend_hp", ctes("yields", bands=BANDS, fw=FORWARD, bw=BACKWARD).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT county_id, year, yield, round(x, 6) AS trend FROM bw")
def detrend_hp(spark, sf_dir):
    return stats.hp_trend(load(spark, sf_dir, "yields"), "county_id", "year", "yield").withColumn("trend", F.round("trend", 6))


@query("yoy_difference", ctes("yields") + "SELECT *, yield - lag(yield) OVER (PARTITION BY county_id ORDER BY year) AS yoy FROM yields")
def yoy_difference(spark, sf_dir):
    return stats.yoy_difference(load(spark, sf_dir, "yields"), "county_id", "year", "yield")


@query("recent_slope", ctes("stats") + """SELECT town_id, round(regr_slope(quantity, year), 6) AS slope, count(*) AS n_years FROM (
  SELECT *, row_number() OVER (PARTITION BY town_id ORDER BY year DESC) AS rn FROM (SELECT town_id, year, sum(quantity) AS quantity FROM stats GROUP BY town_id, year) y) r
  WHERE rn <= 5 GROUP BY town_id""")
def recent_slope(spark, sf_dir):
    return stats.recent_slope(load(spark, sf_dir, "stats"), ["town_id"], "year", "quantity").withColumn("slope", F.round("slope", 6))


@query("downscale_county", ctes("yields", "town_list") + """SELECT town_id, t.county_id, weight, round(total * (weight / nullif(sum(weight) OVER (PARTITION BY t.county_id), 0)), 6) AS allocated
  FROM town_list t LEFT JOIN (SELECT county_id, sum(yield) AS total FROM yields GROUP BY county_id) y USING (county_id)""")
def downscale_county(spark, sf_dir):
    totals = load(spark, sf_dir, "yields").groupBy("county_id").agg(F.sum("yield").alias("total"))
    out = stats.downscale(totals, load(spark, sf_dir, "town_list"), "county_id", "total", "weight")
    return out.select("town_id", "county_id", "weight", F.round("allocated", 6).alias("allocated"))


@query("eda_histogram", ctes("dirty", lim="SELECT min(price) AS lo, (max(price) - min(price)) / 10 AS w FROM dirty") + """SELECT CAST(b AS INT) AS bin, count(price) AS n,
  round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high FROM lim CROSS JOIN range(0, 10) r(b)
  LEFT JOIN dirty ON least(floor((price - lo) / w), 9) = b GROUP BY b, lo, w""")
def eda_histogram(spark, sf_dir):
    out = stats.histogram(load(spark, sf_dir, "dirty"), "price", 10)
    return out.select("bin", "n", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


PAIRS = [(x, y) for x in ("id", "price", "amount") for y in ("id", "price", "amount")]


@query("eda_correlation", ctes("dirty") + " UNION ALL ".join(f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS corr FROM dirty" for x, y in PAIRS))
def eda_correlation(spark, sf_dir):
    return stats.correlation(load(spark, sf_dir, "dirty"), ["id", "price", "amount"]).withColumn("corr", F.round("corr", 6))


@query("impute_median", ctes("dirty") + "SELECT id, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM dirty)) AS price FROM dirty")
def impute_median(spark, sf_dir):
    return clean.handle_missing(load(spark, sf_dir, "dirty").select("id", "price"), {"price": "median"})


@query("impute_mode", ctes("dirty") + """SELECT id, coalesce(priority, (SELECT priority FROM dirty WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1)) AS priority FROM dirty""")
def impute_mode(spark, sf_dir):
    return clean.handle_missing(load(spark, sf_dir, "dirty").select("id", "priority"), {"priority": "mode"})


@query("impute_zero", ctes("dirty") + "SELECT id, coalesce(amount, 0) AS amount FROM dirty")
def impute_zero(spark, sf_dir):
    return clean.handle_missing(load(spark, sf_dir, "dirty").select("id", "amount", "priority"), {"amount": "zero", "priority": "drop"})


@query("exact_quantiles", ctes("dirty") + " UNION ALL ".join(
    f"SELECT status, '{c}' AS \"column\", {p} AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM dirty GROUP BY status"
    for c in ("price", "amount") for p in (0.1, 0.5, 0.9)).replace("0.1 AS prob", "CAST(0.1 AS DOUBLE) AS prob"))
def exact_quantiles(spark, sf_dir):
    from fieldmosaic.operators.ranking import exact_quantiles as quantiles

    out = quantiles(load(spark, sf_dir, "dirty"), ["price", "amount"], [0.1, 0.5, 0.9], ["status"])
    return out.withColumn("value", F.round("value", 6))


@query("outlier_iqr", ctes("dirty", q="SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM dirty") + """
  SELECT id, price, price < a - 0.2 * (b - a) OR price > b + 0.2 * (b - a) AS is_outlier FROM dirty, q""")
def outlier_iqr(spark, sf_dir):
    return clean.outlier_iqr(load(spark, sf_dir, "dirty").select("id", "price"), "price", 0.2)


@query("outlier_zscore", ctes("dirty", q="SELECT avg(price) AS m, stddev_pop(price) AS s FROM dirty") + "SELECT id, price, abs(price - m) / s > 1.5 AS is_outlier FROM dirty, q")
def outlier_zscore(spark, sf_dir):
    return clean.outlier_zscore(load(spark, sf_dir, "dirty").select("id", "price"), "price", 1.5)


@query("encode_label", ctes("dirty") + """SELECT id, priority, code - 1 AS priority_code FROM dirty LEFT JOIN (
  SELECT priority, row_number() OVER (ORDER BY priority) AS code FROM (SELECT DISTINCT priority FROM dirty WHERE priority IS NOT NULL) d) c USING (priority)""")
def encode_label(spark, sf_dir):
    return clean.encode_label(load(spark, sf_dir, "dirty").select("id", "priority"), "priority")


@query("encode_onehot", ctes("dirty") + "SELECT id, " + ", ".join(f"CASE WHEN status = '{s}' THEN 1 ELSE 0 END AS status_{s}" for s in "FOP") + " FROM dirty")
def encode_onehot(spark, sf_dir):
    return clean.encode_onehot(load(spark, sf_dir, "dirty").select("id", "status"), "status", list("FOP"))


@query("scale_standard", ctes("dirty", q="SELECT avg(price) AS m, stddev_pop(price) AS s FROM dirty") + "SELECT id, round((price - m) / s, 6) AS price FROM dirty, q")
def scale_standard(spark, sf_dir):
    return clean.scale(load(spark, sf_dir, "dirty").select("id", "price"), ["price"]).withColumn("price", F.round("price", 6))


@query("scale_minmax", ctes("dirty", q="SELECT min(price) AS m, max(price) AS s FROM dirty") + "SELECT id, round((price - m) / (s - m), 6) AS price FROM dirty, q")
def scale_minmax(spark, sf_dir):
    return clean.scale(load(spark, sf_dir, "dirty").select("id", "price"), ["price"], "minmax").withColumn("price", F.round("price", 6))


@query("interaction_features", ctes("town_list", "town_signals") + "SELECT town_id, year, round(rain_total * soil, 6) AS rain_total_x_soil, round(heat_days * soil, 6) AS heat_days_x_soil FROM town_signals JOIN town_list USING (town_id)")
def interaction_features(spark, sf_dir):
    joined = load(spark, sf_dir, "town_signals").join(load(spark, sf_dir, "town_list"), "town_id")
    out = resilience.interactions(joined, ["rain_total", "heat_days"], ["soil"])
    return out.select("town_id", "year", F.round("rain_total_x_soil", 6).alias("rain_total_x_soil"), F.round("heat_days_x_soil", 6).alias("heat_days_x_soil"))


@query("county_centering", ctes("signals") + "SELECT town_id, year, round(rain_total - avg(rain_total) OVER (PARTITION BY county_id), 6) AS rain_total_c FROM signals")
def county_centering(spark, sf_dir):
    out = resilience.center(load(spark, sf_dir, "signals"), "county_id", ["rain_total"])
    return out.select("town_id", "year", F.round("rain_total_c", 6).alias("rain_total_c"))


@query("effect_model", ctes("yield_features", c="""SELECT target - avg(target) OVER w AS t, rain_total - avg(rain_total) OVER w AS a, heat_days - avg(heat_days) OVER w AS b
  FROM yield_features WINDOW w AS (PARTITION BY county_id)""", s="SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * t) AS at_, sum(b * t) AS bt FROM c") + """
  SELECT 'rain_total' AS feature, round((at_ * bb - bt * ab) / (aa * bb - ab * ab), 4) AS effect FROM s UNION ALL
  SELECT 'heat_days', round((bt * aa - at_ * ab) / (aa * bb - ab * ab), 4) FROM s""")
def effect_model(spark, sf_dir):
    features = ["rain_total", "heat_days"]
    model = resilience.fit_effects(load(spark, sf_dir, "yield_features"), "county_id", "target", features)
    rows = [(name, round(value, 4)) for name, value in resilience.effect_weights(model, features).items()]
    return spark.createDataFrame(rows, "feature string, effect double")


ROUNDS = 6


def random_effects_sql() -> str:
    """The same rounds as a chain of one-row tables; the normal equations of three columns are solved by cofactors."""
    sums = """SELECT county_id, count(*) AS n, sum(rain_total) AS a, sum(heat_days) AS b, sum(target) AS t FROM yield_features
      WHERE target IS NOT NULL AND rain_total IS NOT NULL AND heat_days IS NOT NULL GROUP BY county_id"""
    whole = """SELECT count(*)::DOUBLE AS n, sum(rain_total) AS a, sum(heat_days) AS b, sum(rain_total * rain_total) AS aa, sum(rain_total * heat_days) AS ab, sum(heat_days * heat_days) AS bb,
      sum(target) AS t, sum(rain_total * target) AS at_, sum(heat_days * target) AS bt, sum(target * target) AS tt, count(DISTINCT county_id) AS groups FROM yield_features
      WHERE target IS NOT NULL AND rain_total IS NOT NULL AND heat_days IS NOT NULL"""
    det = "(n * (aa * bb - ab * ab) - a * (a * bb - ab * b) + b * (a * ab - aa * b))"

    def solved(t: str, at: str, bt: str) -> str:
        return f"""({t} * (aa * bb - ab * ab) + {at} * (b * ab - a * bb) + {bt} * (a * ab - b * aa)) / {det} AS b0,
          ({t} * (ab * b - a * bb) + {at} * (n * bb - b * b) + {bt} * (a * b - n * ab)) / {det} AS b1,
          ({t} * (a * ab - aa * b) + {at} * (b * a - n * ab) + {bt} * (n * aa - a * a)) / {det} AS b2"""

    rss = "tt - 2 * (b0 * t + b1 * at_ + b2 * bt) + b0 * b0 * n + b1 * b1 * aa + b2 * b2 * bb + 2 * (b0 * b1 * a + b0 * b2 * b + b1 * b2 * ab)"
    steps = {"r0": f"SELECT b0, b1, b2, ({rss}) / n AS s2, ({rss}) / n AS u2 FROM (SELECT w.*, {solved('t', 'at_', 'bt')} FROM whole w) x"}
    for k in range(1, ROUNDS + 1):
        steps[f"u{k}"] = f"SELECT s.*, u2 / (s2 + s.n * u2) * (t - b0 * s.n - b1 * a - b2 * b) AS u, s2 * u2 / (s2 + s.n * u2) AS v FROM sums s, r{k - 1}"
        steps[f"e{k}"] = f"SELECT sum(n * u) AS nu, sum(a * u) AS au, sum(b * u) AS bu, sum(t * u) AS tu, sum(n * u * u) AS nuu, sum(u * u + v) AS uv, sum(n * v) AS nv FROM u{k}"
        steps[f"r{k}"] = f"""SELECT b0, b1, b2, ({rss} - 2 * (tu - b0 * nu - b1 * au - b2 * bu) + nuu + nv) / n AS s2, uv / groups AS u2
          FROM (SELECT w.*, e.*, {solved('(t - nu)', '(at_ - au)', '(bt - bu)')} FROM whole w, e{k} e) x"""
    last = f"r{ROUNDS}"
    return ctes("yield_features", sums=sums, whole=whole, **steps) + f"""SELECT 'fixed' AS kind, unnest(['', 'rain_total', 'heat_days']) AS name, round(unnest([b0, b1, b2]), 4) AS value FROM {last} UNION ALL
      SELECT 'variance', unnest(['county', 'residual']), round(unnest([u2, s2]), 3) FROM {last} UNION ALL
      SELECT 'county', county_id, round(u2 / (s2 + n * u2) * (t - b0 * n - b1 * a - b2 * b), 3) FROM sums, {last}"""


@query("random_effects", random_effects_sql())
def random_effects(spark, sf_dir):
    found = resilience.fit_random_effects(load(spark, sf_dir, "yield_features"), "county_id", "target", ["rain_total", "heat_days"], rounds=ROUNDS, tolerance=0.0)
    rows = [("fixed", name, round(value, 4)) for name, value in found.fixed.items()]
    rows += [("variance", "county", round(found.var_county, 3)), ("variance", "residual", round(found.var_residual, 3))]
    counties = found.counties.select(F.lit("county").alias("kind"), F.col("county_id").alias("name"), F.round("effect", 3).alias("value"))
    return spark.createDataFrame(rows, "kind string, name string, value double").union(counties)


@query("stability_class", ctes("signals", scored="SELECT *, 0.0::DOUBLE + rain_total * 0.01::DOUBLE + heat_days * -0.5::DOUBLE AS sensitivity FROM signals") + """
  SELECT town_id, year, round(-sensitivity, 6) AS resilience, CAST(ntile(5) OVER (ORDER BY -sensitivity DESC, town_id, year) AS INT) AS stability_class FROM scored""")
def stability_class(spark, sf_dir):
    rows = load(spark, sf_dir, "signals").withColumn("place", F.concat_ws("|", "town_id", F.col("year").cast("string")))
    out = resilience.resilience(rows, {"rain_total": 0.01, "heat_days": -0.5}, 5, "place")
    return out.select("town_id", "year", F.round("resilience", 6).alias("resilience"), "stability_class")


@query("latest_output", ctes("out_paths") + r"""SELECT layer, arg_max(path, day || path) AS path FROM (
  SELECT path, regexp_extract(path, '_processed_(.+)_(\d{8})', 1) AS layer, regexp_extract(path, '_processed_(.+)_(\d{8})', 2) AS day FROM out_paths) p WHERE layer <> '' GROUP BY layer""")
def latest_output(spark, sf_dir):
    return newest_output(load(spark, sf_dir, "out_paths"))


@query("export_roundtrip", ctes("stats") + "SELECT town_id, year, count(*) AS n, sum(quantity) AS quantity FROM stats GROUP BY town_id, year")
def export_roundtrip(spark, sf_dir):
    """Training rows written to the shared folder as CSV and Parquet and read back."""
    folder = f"{checkpoint_folder(spark)}/export-{uuid.uuid4().hex}"
    totals = load(spark, sf_dir, "stats").groupBy("town_id", "year").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))
    written = export_training_set(totals, folder, "002_farmland", "parquet")
    again = export_training_set(spark.read.parquet(written), folder, "002_farmland", "csv")
    return spark.read.schema("town_id string, year int, n long, quantity double").option("header", "true").csv(again)


@query("training_set", ctes("area_pixels", "town_stats", cleaned="SELECT DISTINCT * FROM town_stats", s="""SELECT town_id, sum(quantity) AS quantity_sum, quantile_cont(quantity, 0.5) AS quantity_median
    FROM cleaned GROUP BY town_id""",
    slopes="""SELECT town_id, regr_slope(quantity, year) AS slope FROM (SELECT *, row_number() OVER (PARTITION BY town_id ORDER BY year DESC) AS rn
      FROM (SELECT town_id, year, sum(quantity) AS quantity FROM cleaned GROUP BY town_id, year) y) r WHERE rn <= 5 GROUP BY town_id""",
    j="SELECT area_id, n_pixels, quantity_sum, quantity_median, slope FROM area_pixels LEFT JOIN s ON area_id = s.town_id LEFT JOIN slopes ON area_id = slopes.town_id",
    f="SELECT * REPLACE (coalesce(quantity_sum, 0) AS quantity_sum, coalesce(quantity_median, (SELECT quantile_cont(quantity_median, 0.5) FROM j)) AS quantity_median) FROM j") + """
  SELECT area_id, n_pixels, round((quantity_sum - (SELECT avg(quantity_sum) FROM f)) / (SELECT stddev_pop(quantity_sum) FROM f), 6) AS quantity_sum,
    quantity_median, round(slope, 6) AS slope FROM f""")
def training_set(spark, sf_dir):
    plan = TrainingPlan(
        summary={"quantity": ["sum", "median"]}, missing={"quantity_sum": "zero", "quantity_median": "median"},
        scaled=["quantity_sum"], trend=("year", "quantity"),
    )
    features = load(spark, sf_dir, "area_pixels").select("area_id", "n_pixels")
    out = run(features, load(spark, sf_dir, "town_stats"), plan)
    return out.withColumn("quantity_sum", F.round("quantity_sum", 6)).withColumn("slope", F.round("slope", 6))
