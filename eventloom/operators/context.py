"""Device and app context (CTX1-CTX8).

Input is a ``device_snapshots`` table of raw values a device reported (one row
per device). The context struct follows the reference's nested shape
(app, device, library, os, screen, network, locale, timezone, additional).
Model names come from a literal map, so the lookup is an expression (no join,
no broadcast). Attaching context to events is a join on ``device_id``; the
planner (and AQE at runtime) broadcasts the snapshot side only when its
measured size is under the broadcast threshold, and otherwise shuffles both
sides, with AQE splitting a hot device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: model code → product name (29 entries) -----------------
MODEL_NAMES = {
    "iPhone14,7": "iPhone 13 mini",
    "iPhone14,8": "iPhone 13",
    "iPhone14,2": "iPhone 13 Pro",
    "iPhone14,3": "iPhone 13 Pro Max",
    "iPhone15,4": "iPhone 14",
    "iPhone15,5": "iPhone 14 Plus",
    "iPhone15,2": "iPhone 14 Pro",
    "iPhone15,3": "iPhone 14 Pro Max",
    "iPhone16,1": "iPhone 15 Pro",
    "iPhone16,2": "iPhone 15 Pro Max",
    "iPhone16,3": "iPhone 15",
    "iPhone16,4": "iPhone 15 Plus",
    "iPhone17,1": "iPhone 16 Pro",
    "iPhone17,2": "iPhone 16 Pro Max",
    "iPhone17,3": "iPhone 16",
    "iPhone17,4": "iPhone 16 Plus",
    "iPhone17,5": "iPhone 16e",
    "iPhone18,1": "iPhone 17 Pro",
    "iPhone18,2": "iPhone 17 Pro Max",
    "iPhone18,3": "iPhone 17",
    "iPhone18,4": "iPhone Air",
    "iPad13,18": "iPad (10th generation)",
    "iPad13,19": "iPad (10th generation)",
    "iPad14,3": "iPad Pro 11-inch (4th generation)",
    "iPad14,4": "iPad Pro 11-inch (4th generation)",
    "iPad14,5": "iPad Pro 12.9-inch (6th generation)",
    "iPad14,6": "iPad Pro 12.9-inch (6th generation)",
    "x86_64": "Simulator",
    "arm64": "Simulator",
}
# Fixed defaults: manufacturer, Mac screen when none is reported, screen of an
# unsupported platform.
MANUFACTURER = "Apple"
MAC_DEFAULT_SCREEN = (1920, 1080, 2.0)
OTHER_SCREEN = (0, 0, 1.0)
# ----------------------------------------------------------------------------

DEFAULT_LIBRARY = ("eventloom-spark", "1.0.0")


def _model_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in MODEL_NAMES.items() for x in kv])


def device_model(model_code: Column) -> Column:
    """CTX2: product name for a model code; unknown codes pass through."""
    return F.coalesce(F.element_at(_model_map(), model_code), model_code)


def device_type(idiom: Column, on_mac: Column) -> Column:
    """CTX3: phone/pad → ios, tv → tv, carPlay → car, native Mac → macos,
    any other idiom → macos when the app runs on a Mac, else unknown."""
    return (
        F.when(idiom.isin("phone", "pad"), "ios")
        .when(idiom == "tv", "tv")
        .when(idiom == "carPlay", "car")
        .when(idiom == "mac", "macos")
        .when(idiom.isNotNull() & F.coalesce(on_mac, F.lit(False)), "macos")
        .otherwise("unknown")
    )


def app_context() -> Column:
    """CTX4: display name, else bundle name, else ``Unknown``; others ``unknown``."""
    return F.struct(
        F.coalesce(F.col("display_name"), F.col("bundle_name"), F.lit("Unknown")).alias("name"),
        F.coalesce(F.col("app_version"), F.lit("unknown")).alias("version"),
        F.coalesce(F.col("app_build"), F.lit("unknown")).alias("build"),
        F.coalesce(F.col("bundle_id"), F.lit("unknown")).alias("namespace"),
    )


def os_context() -> Column:
    """CTX5: phone/pad app on a Mac reports ``macOS``; a native Mac app reports
    ``major.minor.patch``; an unsupported platform reports ``unknown``."""
    idiom = F.col("idiom")
    mac_version = F.concat_ws(".", F.col("os_major").cast("string"), F.col("os_minor").cast("string"), F.col("os_patch").cast("string"))
    name = (
        F.when(idiom.isNull(), "unknown")
        .when(idiom == "mac", "macOS")
        .when(F.coalesce(F.col("on_mac"), F.lit(False)), "macOS")
        .otherwise(F.col("system_name"))
    )
    version = F.when(idiom.isNull(), "unknown").when(idiom == "mac", mac_version).otherwise(F.col("system_version"))
    return F.struct(name.alias("name"), version.alias("version"))


def screen_context() -> Column:
    """CTX6: pixels = points × scale, cut to an integer."""
    idiom = F.col("idiom")
    missing = F.col("points_width").isNull() | F.col("points_height").isNull()
    mw, mh, md = MAC_DEFAULT_SCREEN
    ow, oh, od = OTHER_SCREEN
    width = (
        F.when(idiom.isNull(), F.lit(ow))
        .when((idiom == "mac") & missing, F.lit(mw))
        .otherwise((F.col("points_width") * F.col("scale")).cast("bigint"))
    )
    height = (
        F.when(idiom.isNull(), F.lit(oh))
        .when((idiom == "mac") & missing, F.lit(mh))
        .otherwise((F.col("points_height") * F.col("scale")).cast("bigint"))
    )
    density = F.when(idiom.isNull(), F.lit(od)).when((idiom == "mac") & missing, F.lit(md)).otherwise(F.col("scale"))
    return F.struct(density.cast("double").alias("density"), width.cast("bigint").alias("width"), height.cast("bigint").alias("height"))


def context_struct(library: tuple[str, str] = DEFAULT_LIBRARY) -> Column:
    """CTX1-CTX8: the context struct of one snapshot row (advertising id filled later)."""
    idiom = F.col("idiom")
    model = (
        F.when(idiom.isNull(), F.lit("unknown"))
        .when(idiom == "mac", F.col("model_code"))
        .otherwise(device_model(F.col("model_code")))
    )
    dev_name = F.when(idiom.isNull(), F.lit("unknown")).otherwise(F.col("device_name"))
    return F.struct(
        app_context().alias("app"),
        F.struct(
            F.lit(MANUFACTURER).alias("manufacturer"),
            model.alias("model"),
            dev_name.alias("name"),
            device_type(idiom, F.col("on_mac")).alias("type"),
            F.lit(None).cast("string").alias("advertisingId"),
        ).alias("device"),
        F.struct(F.lit(library[0]).alias("name"), F.lit(library[1]).alias("version")).alias("library"),
        os_context().alias("os"),
        screen_context().alias("screen"),
        F.when(F.col("wifi").isNotNull(), F.struct(F.col("wifi").alias("wifi"))).alias("network"),
        F.col("locale").alias("locale"),
        F.col("timezone").alias("timezone"),
        F.create_map().cast("map<string,variant>").alias("additional"),
    )


def with_context(snapshots: DataFrame, library: tuple[str, str] = DEFAULT_LIBRARY) -> DataFrame:
    """Snapshot rows with their context struct added (a projection)."""
    return snapshots.withColumn("context", context_struct(library))


def device_contexts(snapshots: DataFrame, library: tuple[str, str] = DEFAULT_LIBRARY) -> DataFrame:
    """One context struct per snapshot row; ``snapshot_ts`` is kept when present."""
    extra = ["snapshot_ts"] if "snapshot_ts" in snapshots.columns else []
    return with_context(snapshots, library).select("device_id", *extra, "context")


def attach_context(events: DataFrame, contexts: DataFrame, adid_col: str = "advertising_id_state") -> DataFrame:
    """CTX1: left join the device context and set the advertising id as of the
    event. Of several contexts of one device the latest counts (by
    ``snapshot_ts``; without it, one by a hash), so no event is doubled."""
    order = F.col("snapshot_ts") if "snapshot_ts" in contexts.columns else F.xxhash64(F.to_json("context"))
    one = contexts.groupBy("device_id").agg(F.max_by("context", order).alias("context"))
    joined = events.join(one, on="device_id", how="left")
    return joined.withColumn(
        "context",
        F.when(F.col("context").isNotNull(), F.col("context").withField("device.advertisingId", F.col(adid_col))),
    )


def flatten_context(ctx: Column) -> list[Column]:
    """Scalar columns of a context struct (for reports and oracle checks)."""
    return [
        ctx["app"]["name"].alias("app_name"),
        ctx["app"]["version"].alias("app_version"),
        ctx["app"]["build"].alias("app_build"),
        ctx["app"]["namespace"].alias("app_namespace"),
        ctx["device"]["manufacturer"].alias("device_manufacturer"),
        ctx["device"]["model"].alias("device_model"),
        ctx["device"]["name"].alias("device_name"),
        ctx["device"]["type"].alias("device_type"),
        ctx["device"]["advertisingId"].alias("device_advertising_id"),
        ctx["library"]["name"].alias("library_name"),
        ctx["library"]["version"].alias("library_version"),
        ctx["os"]["name"].alias("os_name"),
        ctx["os"]["version"].alias("os_version"),
        ctx["screen"]["density"].alias("screen_density"),
        ctx["screen"]["width"].alias("screen_width"),
        ctx["screen"]["height"].alias("screen_height"),
        ctx["network"]["wifi"].alias("network_wifi"),
        ctx["locale"].alias("locale"),
        ctx["timezone"].alias("timezone"),
    ]


def attach_context_asof(events: DataFrame, contexts: DataFrame, adid_col: str = "advertising_id_state") -> DataFrame:
    """CTX1, as-of form: each event takes the device's latest context whose
    ``snapshot_ts`` is not after the event time (NULL before the first one).

    Events and snapshots are merged per device in time order (a snapshot first
    on a tie) and a skew-safe running ``last`` carries the context forward, so
    a device with very many events or snapshots is still split into chunks.
    """
    from eventloom.plans.scan import running

    ev = events.withColumn("__t", F.col("ts")).withColumn("__k", F.lit(1))
    snaps = contexts.select(
        "device_id", F.col("snapshot_ts").alias("__t"), F.lit(0).alias("__k"), F.col("context").alias("__snap")
    )
    merged = ev.unionByName(snaps, allowMissingColumns=True)
    carried = running(merged, "device_id", ["__t", "__k", "seq"], last={"__ctx": F.col("__snap")})
    out = carried.filter(F.col("__k") == 1).drop("__t", "__k", "__snap")
    return out.withColumn(
        "context", F.when(F.col("__ctx").isNotNull(), F.col("__ctx").withField("device.advertisingId", F.col(adid_col)))
    ).drop("__ctx")
