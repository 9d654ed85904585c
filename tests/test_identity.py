"""Identity as of each call, on hand-made call logs (reference semantics)."""

import datetime as dt

from pyspark.sql import functions as F

from eventloom.operators.envelope import build_events
from eventloom.operators.identity import disabled_drop, identity_asof
from eventloom.schemas import ATTEMPTS_SCHEMA, CALLS_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def calls(spark, rows):
    """rows: (seq, call, name, user_id, group_id, advertising_id, payload_json)."""
    data = [
        ("wk", 1, seq, T0 + dt.timedelta(seconds=seq), call, name, uid, gid, adid, None, payload, None)
        for seq, call, name, uid, gid, adid, payload in rows
    ]
    return spark.createDataFrame(data, CALLS_SCHEMA)


def by_seq(df, *cols):
    return {r.seq: tuple(r[c] for c in cols) for r in df.collect()}


def test_identify_group_reset(spark):
    c = calls(spark, [
        (1, "track", "a", None, None, None, None),
        (2, "identify", None, "u1", None, None, None),
        (3, "group", None, None, "g1", None, None),
        (4, "track", "b", None, None, None, None),
        (5, "identify", None, "", None, None, None),  # empty string is a value
        (6, "reset", None, None, None, None, None),
        (7, "track", "c", None, None, None, None),
        (8, "initialize", None, None, None, None, None),
        (9, "track", "d", None, None, None, None),
    ])
    for width in (0, 2):
        i = by_seq(identity_asof(c, width=width), "epoch", "user_state", "group_state", "initialized", "anonymous_id")
        assert i[1][:3] == (0, None, None)
        assert i[2][:2] == (0, "u1")  # identify sets state before its own event
        assert i[4][:3] == (0, "u1", "g1")
        assert i[5][1] == ""
        assert i[7][:4] == (1, None, None, False)
        assert i[7][4] == "unknown"
        assert i[9][3] is True and i[9][4] != i[1][4]  # new anonymous id after reset + initialize
        assert len(i[9][4]) == 36


def test_advertising_id_rules(spark):
    c = calls(spark, [
        (1, "setAdvertisingId", None, None, None, "ad-1", None),
        (2, "setAdvertisingId", None, None, None, "   ", None),   # blank: ignored
        (3, "setAdvertisingId", None, None, None, "\n", None),    # newline is not blank
        (4, "clearAdvertisingId", None, None, None, None, None),
        (5, "setAdvertisingId", None, None, None, "ad-2", None),
        (6, "setAdvertisingId", None, None, None, None, None),    # explicit nil clears
        (7, "setAdvertisingId", None, None, None, "ad-3", None),
        (8, "reset", None, None, None, None, None),
        (9, "setAdvertisingId", None, None, None, "ad-4", None),  # not ready: ignored
        (10, "initialize", None, None, None, None, None),
        (11, "track", "x", None, None, None, None),
        (12, "setAdvertisingId", None, None, None, "ad-5", None),
    ])
    for width in (0, 3):
        i = by_seq(identity_asof(c, width=width), "advertising_id_state", "consent_state")
        assert i[1] == ("ad-1", "granted")
        assert i[2] == ("ad-1", "granted")
        assert i[3] == ("\n", "granted")
        assert i[4] == (None, "withdrawn")
        assert i[5] == ("ad-2", "granted")
        assert i[6] == (None, "withdrawn")
        assert i[7] == ("ad-3", "granted")
        assert i[8] == (None, "unknown")
        assert i[9] == (None, "unknown")
        assert i[11] == (None, "unknown")
        assert i[12] == ("ad-5", "granted")


def test_envelopes(spark):
    props = '{"name":"old","plan":"pro","n":null}'
    c = calls(spark, [
        (1, "identify", None, "u1", None, None, '{"email":"a@b.c"}'),
        (2, "screen", "Home", None, None, None, props),
        (3, "page", "Docs", None, None, None, None),
        (4, "group", None, None, "", None, None),
        (5, "group", None, None, "g9", None, None),
        (6, "alias", None, "u2", None, None, None),
        (7, "track", "buy", None, None, None, "{bad"),
        (8, "flush", None, None, None, None, None),
    ])
    ev = build_events(identity_asof(c))
    rows = {r.seq: r for r in ev.collect()}
    assert 8 not in rows  # flush emits no event
    assert rows[1].userId == "u1" and rows[1].traits is not None
    assert rows[2].event is None
    screen = ev.filter(F.col("seq") == 2).select(F.to_json("properties").alias("j")).first().j
    assert '"name":"Home"' in screen and '"plan":"pro"' in screen and '"n":null' in screen
    page = ev.filter(F.col("seq") == 3).select(F.to_json("properties").alias("j")).first().j
    assert page == '{"name":"Docs"}'
    assert rows[4].properties is None and rows[4].groupId == ""
    assert rows[5].groupId == "g9"
    assert rows[6].userId == "u2" and rows[6].properties is None  # previousId only if given
    assert rows[7].properties is None and rows[7].props_ok is False
    mid = rows[7].messageId
    assert mid.split("-")[0] == str(int((T0 + dt.timedelta(seconds=7)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
    assert rows[7].timestamp == "2024-01-01T00:00:07Z"


def test_disabled_drop(spark):
    c = calls(spark, [
        (1, "track", "a", None, None, None, None),
        (3, "identify", None, "u1", None, None, None),   # after the 401: dropped
        (5, "reset", None, None, None, None, None),      # never dropped
        (6, "track", "b", None, None, None, None),
    ])
    a = spark.createDataFrame(
        [("wk", 1, 0, T0 + dt.timedelta(seconds=2), 1, 1, 401, {})], ATTEMPTS_SCHEMA
    )
    for width in (0, 1 << 20):
        kept = sorted(r.seq for r in disabled_drop(c, a, width=width).collect())
        assert kept == [1, 5, 6]


def test_alias_option_and_custom_ids(spark):
    c = calls(spark, [
        (1, "alias", None, "u-new", None, None, None),
        (2, "track", "a", None, None, None, None),
    ])
    coded = by_seq(identity_asof(c), "user_state")
    documented = by_seq(identity_asof(c, alias_sets_user=True), "user_state")
    assert coded[2] == (None,) and documented[2] == ("u-new",)
    ev = build_events(identity_asof(c).withColumn("mid", F.lit("1-550E8400-E29B-41D4-A716-446655440000")), message_id_col="mid")
    assert {r.messageId for r in ev.collect()} == {"1-550E8400-E29B-41D4-A716-446655440000"}


def test_null_as_string_option(spark):
    c = calls(spark, [(1, "track", "x", None, None, None, '{"a":null,"b":1}')])
    keep = build_events(identity_asof(c)).select(F.to_json("properties").alias("j")).first().j
    text = build_events(identity_asof(c), null_as_string=True).select(F.to_json("properties").alias("j")).first().j
    assert keep == '{"a":null,"b":1}'
    assert text == '{"a":"null","b":1}'


def test_journey_links_pre_and_post(spark):
    from eventloom.operators.journeys import funnel, journeys

    c = calls(spark, [
        (1, "track", "browse", None, None, None, None),
        (2, "alias", None, "u9", None, None, None),
        (3, "identify", None, "u9", None, None, None),
        (4, "track", "purchase", None, None, None, None),
    ])
    j = journeys(build_events(identity_asof(c)))
    got = {r.seq: (r.person_id, r.phase) for r in j.collect()}
    assert got == {1: ("u9", "pre"), 2: ("u9", "post"), 3: ("u9", "post"), 4: ("u9", "post")}
    f = funnel(j).first()
    assert (f.n_people, f.n_identified, f.n_converted, f.n_converted_after_identify) == (1, 1, 1, 1)


def test_identity_edge_ids(spark):
    c = calls(spark, [
        (1, "identify", None, "用户-ü-✓ <&>", None, None, None),
        (2, "group", None, None, "grüppe/1", None, None),
        (3, "track", "x", None, None, None, None),
    ])
    i = by_seq(identity_asof(c), "user_state", "group_state")
    assert i[3] == ("用户-ü-✓ <&>", "grüppe/1")


def test_two_snapshots_of_a_device_do_not_double_its_events(spark):
    from eventloom.operators.context import attach_context

    events = spark.createDataFrame([(1, 1, "ad"), (1, 2, None), (2, 1, "x"), (None, 1, "y")], "device_id long, seq long, advertising_id_state string")
    rows = [(1, "2024-01-01", "old"), (1, "2024-01-02", "new"), (1, "2024-01-02", "new")]
    contexts = spark.createDataFrame(rows, "device_id long, day string, m string").selectExpr(
        "device_id", "CAST(day AS timestamp) AS snapshot_ts", "struct(struct(m AS model, CAST(NULL AS string) AS advertisingId) AS device) AS context")
    for c in (contexts, contexts.drop("snapshot_ts")):
        got = sorted(((r.device_id, r.seq), r.context and r.context.device.advertisingId) for r in attach_context(events, c).collect() if r.device_id)
        assert got == [((1, 1), "ad"), ((1, 2), None), ((2, 1), None)]
    assert {r.context.device.model for r in attach_context(events, contexts).collect() if r.context} == {"new"}
