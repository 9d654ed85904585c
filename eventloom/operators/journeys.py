"""Person journeys through alias links (XT1, XT2; README-level use cases).

Events before sign-up carry only an anonymous id; the alias event links that
anonymous id to the user id. The first link per anonymous id (``min_by``, a
partial aggregate) is joined back, so every event gets a ``person_id`` and a
``pre``/``post`` phase. ``unknown`` is not an identity and is never linked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_links(events: DataFrame) -> DataFrame:
    a = events.filter((F.col("type") == "alias") & (F.col("anonymousId") != "unknown"))
    return a.groupBy(F.col("anonymousId").alias("__anon")).agg(
        F.min_by("userId", "seq").alias("__linked_user"), F.min("seq").alias("__link_seq")
    )


def journeys(events: DataFrame) -> DataFrame:
    """XT1: ``person_id`` and phase (``pre``/``post`` the link, ``none``).

    Events with the anonymous id ``unknown`` (before ``initialize``) can never
    match a link and would all hash to one join partition, so they bypass the
    join and are added back with a union.
    """
    known = events.filter(F.col("anonymousId") != "unknown")
    unknown = events.filter(~(F.col("anonymousId") != "unknown") | F.col("anonymousId").isNull())
    linked = known.join(first_links(events), F.col("anonymousId") == F.col("__anon"), "left")
    j = linked.unionByName(unknown, allowMissingColumns=True)
    person = F.coalesce(F.col("__linked_user"), F.col("userId"), F.col("anonymousId"))
    phase = F.when(F.col("__link_seq").isNull(), "none").when(F.col("seq") < F.col("__link_seq"), "pre").otherwise("post")
    return j.withColumn("person_id", person).withColumn("phase", phase).drop("__anon", "__linked_user", "__link_seq")


def funnel(journey: DataFrame) -> DataFrame:
    """XT2: people reaching anonymous → identified → converted (purchase). A
    person may have several devices, so steps are ordered by time: ``seq`` only
    orders one device's calls."""
    per = journey.groupBy("person_id").agg(
        F.min(F.when(F.col("userId").isNotNull(), F.col("ts"))).alias("identified"),
        F.min(F.when((F.col("type") == "track") & (F.col("event") == "purchase"), F.col("ts"))).alias("converted"),
    )
    return per.agg(
        F.count(F.lit(1)).alias("n_people"),
        F.count("identified").alias("n_identified"),
        F.count("converted").alias("n_converted"),
        F.count(F.when(F.col("converted") > F.col("identified"), 1)).alias("n_converted_after_identify"),
    )
