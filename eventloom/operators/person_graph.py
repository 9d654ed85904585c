"""People as connected identities (IDN6, XT1 over chained links).

``alias`` and ``identify`` events link the anonymous id they carry to a user id.
Links chain: two devices that name the same user are one person, and so is a
user that is aliased to another. ``connected`` finds the components by large and
small stars in turn: every node hands its larger neighbours to the smallest node
it knows, then its smaller ones. Paths shrink by powers, so the number of rounds
does not follow the length of a chain; a round is two joins on the node, each
against one row a node, so a hub only makes its side of a join long, which
adaptive execution splits. Rounds are checkpointed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.plans.scan import DEFAULT_WIDTH, running
from eventloom.session import ensure_checkpoint_dir

UNKNOWN = "unknown"


def identity_links(events: DataFrame) -> DataFrame:
    """``(anonymous_id, user_id)`` pairs named by ``alias`` and ``identify``
    events; ``unknown`` and empty user ids link nothing."""
    e = events.where(F.col("type").isin("alias", "identify") & (F.col("anonymousId") != UNKNOWN) & (F.col("userId") != ""))
    return e.select(F.col("anonymousId").alias("anonymous_id"), F.col("userId").alias("user_id")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``, the root being the
    smallest node of its component. Loops and repeated edges do no harm; edges
    with a NULL end are ignored; a node that is only linked to itself is its own
    root; no edges give no rows."""
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct().checkpoint()
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    stars, before = edges.where("a <> b"), None
    while True:
        stars = _small_star(_large_star(stars)).checkpoint()
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if now == before:
            break
        before = now
    return nodes.join(stars.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least")).select("of", F.least("of", "least").alias("low"))
    return both.where("b > a").join(low, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    low = down.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))
    joined = down.join(low, F.col("a") == F.col("of"))
    return joined.select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()


def _node(kind: str, col: Column) -> Column:
    # Users sort before anonymous ids, so that a root is the smallest user.
    return F.concat(F.lit("0:" if kind == "user" else "1:"), col)


def person_graph(links: DataFrame) -> DataFrame:
    """``kind`` (``user`` or ``anonymous``), ``id`` and ``person_id``, the
    smallest user id reachable through ``links(anonymous_id, user_id)``."""
    nodes = connected(links.select(_node("anonymous", F.col("anonymous_id")).alias("a"), _node("user", F.col("user_id")).alias("b")))
    return nodes.select(
        F.when(F.col("node").startswith("0:"), "user").otherwise("anonymous").alias("kind"), F.expr("substring(node, 3)").alias("id"), F.expr("substring(root, 3)").alias("person_id"))


def people(events: DataFrame, graph: DataFrame) -> DataFrame:
    """XT1 report: devices, ids and events of each person. An event belongs to
    the person of its anonymous id or, if that is unlinked or unknown, of its
    user id; other events have no person. Events are counted per id and
    device before the joins, so a hot device is one row there."""
    by_id = events.groupBy(F.col("anonymousId").alias("anon"), F.col("userId").alias("user"), "device_id").agg(F.count("*").alias("n"))
    of = lambda kind, key: graph.where(F.col("kind") == kind).select(F.col("id").alias(key), F.col("person_id").alias(f"{key}_person"))
    named = by_id.join(of("anonymous", "anon"), "anon", "left").join(of("user", "user"), "user", "left")
    counted = named.groupBy(F.coalesce("anon_person", "user_person").alias("person_id")).agg(
        F.count_distinct("device_id").alias("n_devices"), F.sum("n").alias("n_events"))
    ids = graph.groupBy("person_id").agg(F.count("*").alias("n_ids"))
    return ids.join(counted, "person_id", "left").select("person_id", "n_ids", F.coalesce("n_devices", F.lit(0)).alias("n_devices"), F.coalesce("n_events", F.lit(0)).alias("n_events"))


def journeys_asof(events: DataFrame, width: int | None = DEFAULT_WIDTH) -> DataFrame:
    """XT1 with links that change: the user an anonymous id is linked to as of
    each event. A link holds from its ``alias`` until the next one of the same
    anonymous id, so the interval an event falls into is a running value; no
    range join. Adds ``person_id`` (the link in force, else the event's user,
    else the anonymous id) and ``link_no`` (0: before the first link)."""
    is_link = (F.col("type") == "alias") & (F.col("anonymousId") != UNKNOWN)
    j = running(events, ["anonymousId", "device_id"], "seq", last={"linked": F.when(is_link, F.col("userId"))}, total={"link_no": F.coalesce(is_link, F.lit(False)).cast("bigint")}, width=width)
    return j.withColumn("person_id", F.coalesce("linked", "userId", "anonymousId")).drop("linked")
