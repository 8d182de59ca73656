"""Map requests as a plan table, and the triage of logged responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldmosaic.functions.url import add_query, keep_query

MAX_RETRIES = 3
FIRST_WAIT = 5


def layer_area_plan(layers: DataFrame, areas: DataFrame) -> DataFrame:
    """Every layer with every area.

    Areas are spread over slots by hash, one slot per shuffle partition, and each layer is sent
    to all slots, so the product is an ordinary equi-join whatever the sizes.
    """
    slots = int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = areas.withColumn("_slot", F.pmod(F.xxhash64("area_id", "shp_version"), F.lit(slots)))
    copies = layers.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<bigint>")))
    return copies.join(spread, "_slot").drop("_slot")


def request_plan(layers: DataFrame, areas: DataFrame) -> DataFrame:
    """One request per layer and area; areas carry box, width and height.

    The part of a layer's URL that stays is worked out once per layer, before the product.
    """
    names = ["BBOX", "WIDTH", "HEIGHT"]
    prepared = layers.withColumn("_kept", keep_query(F.col("map_url"), names))
    corners = F.concat_ws(",", *[F.col(f"box.{c}").cast("string") for c in ("minx", "miny", "maxx", "maxy")])
    url = add_query(F.col("_kept"), dict(zip(names, (corners, F.col("width"), F.col("height")))))
    return layer_area_plan(prepared, areas).withColumn("request_url", url).drop("_kept")


def response_triage(log: DataFrame) -> DataFrame:
    """What to do after each logged attempt (counted from 0).

    HTTP errors and time-outs are retried after 5, 10 and 20 seconds and given up after that;
    other failures end at once; a success counts only when the content is an image. Client
    errors are retried like server errors and flagged.
    """
    status = F.col("status")
    http_error = F.coalesce(status >= 400, F.lit(False))
    timeout = F.coalesce(F.col("error") == "timeout", F.lit(False))
    failed = F.col("error").isNotNull() & ~timeout
    retryable = http_error | timeout
    left = F.col("attempt") < MAX_RETRIES
    image = F.coalesce(F.contains("content_type", F.lit("image")), F.lit(False))
    action = (
        F.when(retryable & left, "retry").when(retryable, "give_up").when(failed, "fail")
        .when(image, "keep").otherwise("not_image")
    )
    wait = F.when(retryable & left, FIRST_WAIT * F.pow(F.lit(2), F.col("attempt"))).cast("int")
    client = F.coalesce((status >= 400) & (status < 500), F.lit(False))
    return log.withColumn("action", action).withColumn("wait_s", wait).withColumn("client_error", client)
