"""Calls on stream state grow with shares and parts touched, not with events."""
from pyspark.sql import Row

from sluice.spec import PipelineConfig
from sluice.streaming.groups import CONTROL, COPY, EVENT, EventTimeGroupProcessor, KeyMarks, TAGGED_TYPE

CFG = PipelineConfig()
TAGGED = Row("dedup_key", *[f.split()[0] for f in TAGGED_TYPE.split(", ")])


class Handle:
    """State in memory that counts the calls made on it."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema, ttlDurationMs=None):
        return State(self)

    getListState = getMapState = getValueState

    def registerTimer(self, moment):
        self.calls += 1
        self.timers.add(moment)

    def deleteTimer(self, moment):
        self.calls += 1
        self.timers.discard(moment)


class State:
    def __init__(self, handle):
        self.handle, self.held = handle, {}

    def __getattribute__(self, name):
        if name in ("handle", "held") or name.startswith("__"):
            return object.__getattribute__(self, name)
        self.handle.calls += 1
        held = self.held

        def append(values):
            held.setdefault(None, []).extend(values)
        return {"exists": lambda: bool(held), "clear": held.clear, "appendList": append,
                "get": lambda: held.get(None), "update": lambda v: held.__setitem__(None, v),
                "getValue": held.get, "updateValue": held.__setitem__, "containsKey": held.__contains__,
                "removeKey": lambda k: held.pop(k, None), "iterator": lambda: iter(list(held.items()))}[name]


class Expired:
    def __init__(self, moment):
        self.moment = moment

    def getExpiryTimeInMs(self):
        return self.moment


def started(processor):
    handle = Handle()
    processor.init(handle)
    return processor, handle


def event(key, n, trade_id=None, time_ms=0):
    return TAGGED(key, "A", EVENT, trade_id or key, 0, n, "file", time_ms, None, None)


def control(ids):
    return TAGGED(None, "A", CONTROL, None, 0, 0, None, 0, len(ids), ids)


def test_keys_of_a_share_are_marked_together():
    marks, handle = started(KeyMarks(CFG, event_time=True))
    sent = [event(f"k{n}", n) for n in range(2000)]
    got = list(marks.handleInputRows((0,), iter(sent + [event("k7", 9000)]), None))
    assert [(r.kind, r.arrival) for r in got if r.kind == COPY] == [(COPY, 9000)] and len(got) == 2001
    again = [event("k1", 9001), event("new", 9002), event("k1", 9003, time_ms=marks.ttl_ms)]
    assert sorted((r.arrival, r.kind) for r in marks.handleInputRows((0,), iter(again), None)) == [
        (9001, COPY), (9002, EVENT), (9003, EVENT)]
    assert handle.calls < 20
    for moment in sorted(handle.timers):
        list(marks.handleExpiredTimer((0,), None, Expired(moment)))
        if moment == marks.ttl_ms:
            assert list(marks._held()) == ["k1"]
    assert not marks._held()


def test_events_of_a_group_are_put_in_their_parts_together():
    ids = [str(n) for n in range(2000)]
    group, handle = started(EventTimeGroupProcessor(CFG))
    list(group.handleInputRows(("A",), iter([control(ids)]), None))
    first = [event(i, n) for n, i in enumerate(ids[:-1])]
    repeat = [event("other", 5000, ids[3]), event("early", -5, ids[4])]
    got = list(group.handleInputRows(("A",), iter(first + repeat), None))
    assert sorted((r.trade_id, r.arrival, r.outcome) for r in got) == [("3", 5000, "DUPLICATE"), ("4", 4, "DUPLICATE")]
    late = [event("last", 6000, ids[-1]), event("stray", 7000, "x"), event("stray2", 7001, "x")]
    got = list(group.handleInputRows(("A",), iter(late), None))
    assert sorted(r.trade_id for r in got if r.outcome == "SUCCESS") == sorted(ids)
    assert [r.arrival for r in got if r.outcome == "DLQ_ROUTED"] == [7000, 7001]
    assert [(r.status, r.actual_count, r.arrival) for r in got if r.kind == "group"] == [("SUCCESS", 2000, 6000)]
    assert handle.calls < 150


def test_events_before_their_document_wait_in_chunks():
    ids = [str(n) for n in range(2500)]
    group, handle = started(EventTimeGroupProcessor(CFG))
    assert not list(group.handleInputRows(("A",), iter([event(i, n) for n, i in enumerate(ids)]), None))
    got = list(group.handleInputRows(("A",), iter([control(ids)]), None))
    assert sorted(r.trade_id for r in got if r.outcome == "SUCCESS") == sorted(ids)
    assert handle.calls < 150
