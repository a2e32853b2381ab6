"""Rows go through state operators packed, and a large group's parts are not written each time."""
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.spec import PipelineConfig
from sluice.streaming import packs
from sluice.streaming.groups import EventTimeGroupProcessor
from tests.test_state_calls import Expired, Handle, State, control, event

CFG = PipelineConfig()


class MapState(State):
    def __getattribute__(self, name):
        if name == "keys":
            return lambda: iter(list(object.__getattribute__(self, "held")))
        return super().__getattribute__(name)


class MapHandle(Handle):
    def getValueState(self, name, schema, ttlDurationMs=None):
        return MapState(self)

    getListState = getMapState = getValueState


def announced(ids):
    group, handle = EventTimeGroupProcessor(CFG), MapHandle()
    group.init(handle)
    list(group.handleInputRows(("A",), iter([control(ids)]), None))
    return group


def test_parts_are_left_alone_until_the_group_may_be_whole():
    ids = [str(n) for n in range(3000)]
    group = announced(ids)
    before = dict(group.slots.held)
    for n in range(11):
        assert not list(group.handleInputRows(("A",), (event(i, int(i)) for i in ids[n::12]), None))
    assert group.slots.held == before
    last = [event(i, int(i)) for i in ids[11::12]] + [event("again", -5, "0"), event("more", 9000, "1")]
    got = list(group.handleInputRows(("A",), iter(last), None))
    assert sorted(r.trade_id for r in got if r.outcome == "SUCCESS") == sorted(ids)
    assert sorted((r.trade_id, r.arrival) for r in got if r.outcome == "DUPLICATE") == [("0", 0), ("1", 9000)]
    assert not group.later.held


def test_events_put_off_are_decided_when_their_group_fails():
    group = announced([str(n) for n in range(3000)])
    sent = [event(str(n), n) for n in range(10)] + [event("again", 50, "3"), event("x", 60, "x")]
    for e in sent:
        assert not list(group.handleInputRows(("A",), iter([e]), None))
    got = list(group.handleExpiredTimer(("A",), None, Expired(group.timeout_ms)))
    assert sorted(r.arrival for r in got if r.kind != "group") == sorted(e.arrival for e in sent)
    assert [(r.trade_id, r.arrival) for r in got if r.outcome == "DUPLICATE"] == [("3", 50)]
    assert [(r.actual_count, r.missing_count) for r in got if r.kind == "group"] == [(11, 2990)]


def test_packed_rows_come_out_as_they_went_in(spark):
    rows = [("a" if n % 3 else None, n, None if n % 5 else f"ü{n}", n if n % 2 else None, None if n % 7 else ["x", str(n)], "same")
            for n in range(200)]
    df = spark.createDataFrame(rows, "k string, n bigint, text string, maybe int, ids array<string>, same string").repartition(3)
    held = packs.packed(df, "k").collect()
    assert len(held) < 20
    got = [(r.k, *e) for r in held for e in packs.unpack_rows([r])]
    assert sorted(got, key=lambda r: r[1]) == rows
    made = list(packs.pack_rows((Row("n", "t")(n, str(n)) for n in range(2500)), Row("n", "t")))
    assert len(made) == 3
    out = packs.unpacked(spark.createDataFrame(made, packs.packed_type("n bigint, t string")))
    assert out.agg(F.count("*"), F.count_if(F.col("n").cast("string") == F.col("t"))).first() == (2500, 2500)
