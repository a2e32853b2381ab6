"""Group state machine of the stream.

Control documents and events of one group meet in keyed state. State holds no payloads: an
event lies there as its arrival number and its claim, which says where its record can be
read again. Announced ids lie in parts of some hundreds, each a list of ids and of the events
that fill them, with a counter of those filled. Events that cannot complete their group yet
are put off, part by part, as they came: parts are read and written only when the group may
be whole, after some rounds, or when it fails. Timers stand for the wait for a control document, for the deadline of the group,
and for the time a closed group is remembered.

A call on state costs far more than what it carries, so marks of keys are kept in shares,
too: the calls grow with shares and parts touched, not with events. What a call carries is
JSON text, since lists are taken apart value by value on their way into state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from operator import attrgetter
from zlib import crc32

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluice.spec import (
    BATCH_TIMEOUT, DLQ_ROUTED, DUPLICATE, GROUP_FAIL, GROUP_SUCCESS, NO_CONTROL_DOC, PipelineConfig,
    SUCCESS,
)
from sluice.streaming.packs import pack_rows, unpack_rows

CONTROL = "control"
EVENT = "event"
COPY = "copy"  # an event whose key was marked before; only passes through
GROUP = "group"
INCOMPLETE = "incomplete"  # an announced event whose group failed
UNANNOUNCED = "unannounced"  # an event of a failed group whose id was never announced

# Input: both kinds of record under one schema
TAGGED_TYPE = (
    "trade_group_id string, kind string, trade_id string, attempt_count int, arrival bigint, "
    "claim string, time_ms bigint, expected_count int, trade_ids array<string>"
)

# Output: decisions on events and on groups; an event's record is fetched by its claim
DECISION_TYPE = (
    "kind string, trade_group_id string, trade_id string, attempt_count int, arrival bigint, "
    "claim string, outcome string, failure_reason string, status string, "
    "expected_count int, actual_count int, missing_count int"
)
_OUT = [f.split()[0] for f in DECISION_TYPE.split(", ")]
_MARKED = [f.split()[0] for f in TAGGED_TYPE.split(", ")]
_Marked = Row(*_MARKED)
_Decision = Row(*_OUT)
_passed_on = attrgetter(*_MARKED)
_KIND = _MARKED.index("kind")

_HELD = "arrival bigint, claim string, attempt_count int"
_EVENT = f"trade_id string, {_HELD}"
_CHUNK = 1000  # events that wait together
_FILL = 500_000  # events put under their control document together
_PART = 500  # announced ids kept together
_ROUNDS = 32  # times a group's events are put off
_STRAY_PARTS = 256  # parts of the ids that came unannounced
KEY_SHARES = 1 << 12  # idempotency keys are marked together by their hash
_SWEEPS_PER_TTL = 60  # marks of a share are removed at that many moments of their time to live
_MARK_PARTS = 16  # micro-batches whose marks of one moment lie apart
_DEADLINE = 7  # its place in the state of an open group
_AWAITED = -1  # arrival of an announced id that no event has filled yet
_SLOTS_PER_WAIT = 60  # waiting events share that many moments at which they are given up


def _row(**values) -> Row:
    return _Decision(*[values.get(name) for name in _OUT])


def _part(trade_id: str | None, parts: int) -> int:
    return crc32((trade_id or "").encode()) % parts


def _by_part(items, parts: int, trade_id=lambda item: item) -> dict[int, list]:
    out: dict[int, list] = {}
    for item in items:
        out.setdefault(_part(trade_id(item), parts), []).append(item)
    return out


class KeyMarks(StatefulProcessor):
    """Keyed by a share of the idempotency keys: a key's first event marks it, later ones
    become copies.

    The mark holds for its time to live, by the clock or, with ``event_time``, counted from
    the marking event's own time: no watermark stands before the mark, so an event of any
    age is decided. Within a micro-batch one event at most marks a key, that of smallest
    arrival number.
    """

    def __init__(self, cfg: PipelineConfig, event_time: bool = False):
        self.ttl_ms = cfg.dedup_ttl_minutes * 60 * 1000
        self.sweep_ms = max(1, self.ttl_ms // _SWEEPS_PER_TTL)
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kept = {} if self.event_time else {"ttlDurationMs": self.ttl_ms}
        # A micro-batch adds its marks as parts of their own and leaves the older ones as they lie.
        self.marks = handle.getMapState("marks", "moment bigint, part int", "marks string", **kept)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        parts = self._parts()
        marks = self._joined(parts)
        clock = None if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        firsts: dict[str, Row] = {}
        for r in rows:
            until = marks.get(r.dedup_key)
            first = firsts.get(r.dedup_key)
            marked = until is not None and (r.time_ms if self.event_time else clock) < until
            if marked or (first is not None and r.arrival > first.arrival):
                yield self._passed(r, COPY)
                continue
            if first is not None:
                yield self._passed(first, COPY)
            firsts[r.dedup_key] = r
        fresh: dict[int, dict[str, int]] = {}
        for k, r in firsts.items():
            until = (r.time_ms if self.event_time else clock) + self.ttl_ms
            fresh.setdefault(self._sweep(until), {})[k] = until
        for moment, some in fresh.items():
            self._add(moment, parts, some)
        for r in firsts.values():
            yield self._passed(r, EVENT)

    def _add(self, moment: int, parts: dict[tuple[int, int], dict], some: dict[str, int]) -> None:
        """Put marks behind the parts of their moment; where these are many, make them one."""
        there = [n for at, n in parts if at == moment]
        if not there and self.event_time:
            self.handle.registerTimer(moment)
        if self.event_time and len(there) >= _MARK_PARTS:
            some = self._joined({n: parts[moment, n] for n in there} | {None: some})
            for n in there[1:]:
                self.marks.removeKey((moment, n))
            there = []
        self.marks.updateValue((moment, max(there, default=-1) + 1), (json.dumps(some),))

    def _parts(self) -> dict[tuple[int, int], dict[str, int]]:
        return {tuple(at): json.loads(held[0]) for at, held in self.marks.iterator()}

    @staticmethod
    def _joined(parts: dict) -> dict[str, int]:
        marks: dict[str, int] = {}
        for some in parts.values():
            for k, until in some.items():
                marks[k] = max(until, marks.get(k, until))
        return marks

    def _held(self) -> dict[str, int]:
        return self._joined(self._parts())

    def _sweep(self, until: int) -> int:
        """The moment, shared by marks, at which one that ran out is removed."""
        return -(-until // self.sweep_ms) * self.sweep_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        moment = expiredTimerInfo.getExpiryTimeInMs()
        for at, n in [tuple(at) for at, _ in self.marks.iterator()]:
            if at <= moment:
                self.marks.removeKey((at, n))
        return iter(())

    @staticmethod
    def _passed(r: Row, kind: str) -> Row:
        values = _passed_on(r)
        return _Marked(*values[:_KIND], kind, *values[_KIND + 1:])


class GroupProcessor(StatefulProcessor):
    """Keyed by ``trade_group_id``; timers follow the clock."""

    event_time = False

    def __init__(self, cfg: PipelineConfig):
        self.wait_ms = cfg.control_wait_ms
        self.timeout_ms = cfg.group_timeout_ms
        self.closed_ttl_ms = cfg.dedup_ttl_minutes * 60 * 1000
        self.slot_ms = max(1, self.wait_ms // _SLOTS_PER_WAIT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # An open group: what was announced and how much of it is there.
        self.open = handle.getValueState(
            "open", "expected int, wanted int, filled int, last bigint, stale boolean, "
                    "strays int, first_stray bigint, deadline bigint, put_off int, rounds int")
        # A part of the announced ids: ids, arrivals, claims by number, attempts and the claims.
        self.slots = handle.getMapState("slots", "part int", "slots string")
        # Events put off, by part and round.
        self.later = handle.getMapState("later", "part int, round int", "events string")
        self.strays = handle.getListState("strays", _EVENT)
        self.stray_ids = handle.getMapState("stray_ids", "part int", "ids array<string>")
        # Events without control document, in numbered parts per moment they are given up.
        self.dues = handle.getMapState("dues", "due bigint", "parts int")
        self.waiting = handle.getMapState("waiting", "due bigint, part int", "events string")
        self.closed = handle.getValueState("closed", "until bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        group = key[0]
        clock = timerValues.getCurrentProcessingTimeInMs() if not self.event_time else None
        arrived: dict[int, list] = {}
        claims: dict[str, str] = {}  # events of a file share one text
        room = None
        for r in rows:
            now = r.time_ms if self.event_time else clock
            if r.kind == CONTROL:
                yield from self._register(group, r, now)
                room = None
            elif r.kind == COPY:
                yield _row(kind=EVENT, trade_group_id=group, trade_id=r.trade_id,
                           attempt_count=r.attempt_count, arrival=r.arrival, claim=r.claim,
                           outcome=DUPLICATE)
            else:
                due = -(-(now + self.wait_ms) // self.slot_ms) * self.slot_ms
                part = arrived.setdefault(due, [])
                part.append((r.trade_id, r.arrival, claims.setdefault(r.claim, r.claim), r.attempt_count))
                if len(part) < _CHUNK:
                    continue
                if room is None:
                    room = _FILL if self.open.exists() else _CHUNK
                if len(part) >= room:
                    yield from self._take(group, due, arrived.pop(due))
        for due, part in arrived.items():
            yield from self._take(group, due, part)
        if self.open.exists():
            yield from self._settle(group)

    def _register(self, group: str, doc: Row, now: int) -> Iterator[Row]:
        """First document wins while the group is open or remembered as closed."""
        if self.open.exists() or (self.closed.exists() and self.closed.get()[0] > now):
            return
        ids = set(doc.trade_ids)
        for part, some in _by_part(ids, self._parts_of(len(ids))).items():
            self._hold(part, dict.fromkeys(some, (_AWAITED, None, 0)))
        deadline = now + self.timeout_ms
        self.open.update((doc.expected_count, len(ids), 0, None, False, 0, None, deadline, 0, 0))
        self.handle.registerTimer(deadline)
        together = []
        for due, parts in [(k[0], v[0]) for k, v in self.dues.iterator()]:
            self.handle.deleteTimer(due)
            for events in self._parts(due, parts):
                together += events
                if len(together) >= _FILL:
                    yield from self._fill(group, together)
                    together = []
        if together:
            yield from self._fill(group, together)

    @staticmethod
    def _parts_of(wanted: int) -> int:
        return -(-wanted // _PART) or 1

    def _hold(self, part: int, slots: dict[str, tuple]) -> None:
        """Write a part of the announced ids: id to arrival, claim and attempts."""
        claims = {claim: n for n, claim in enumerate(dict.fromkeys(v[1] for v in slots.values()))}
        self.slots.updateValue((part,), (json.dumps([
            list(slots), [v[0] for v in slots.values()], [claims[v[1]] for v in slots.values()],
            [v[2] for v in slots.values()], list(claims)]),))

    @staticmethod
    def _unpacked(held: tuple | None) -> dict[str, tuple]:
        if held is None:
            return {}
        ids, arrivals, at, attempts, claims = json.loads(held[0])
        return {i: (arrival, claims[n], attempt)
                for i, arrival, n, attempt in zip(ids, arrivals, at, attempts)}

    def _parts(self, due: int, parts: int) -> Iterator[list]:
        """Waiting events of one moment, part by part; they wait no longer."""
        self.dues.removeKey((due,))
        for part in range(parts):
            events = [tuple(e) for e in json.loads(self.waiting.getValue((due, part))[0])]
            self.waiting.removeKey((due, part))
            yield events

    def _take(self, group: str, due: int, events: list) -> Iterator[Row]:
        """Put events under their control document, or let them wait for it."""
        if self.open.exists():
            yield from self._fill(group, events)
            return
        held = self.dues.getValue((due,))
        parts = held[0] if held is not None else 0
        if not parts:
            self.handle.registerTimer(due)
        self.waiting.updateValue((due, parts), (json.dumps(events),))
        self.dues.updateValue((due,), (parts + 1,))

    def _fill(self, group: str, events: list, last_call: bool = False) -> Iterator[Row]:
        """Announced ids are filled by their first event; its repeats are duplicates.

        While events put off and given cannot make the group whole, they are put off.
        """
        (expected, wanted, filled, last, stale, strays, first_stray, deadline, put_off,
         rounds) = self.open.get()
        came = _by_part(events, self._parts_of(wanted), lambda e: e[0])
        if put_off + len(events) < wanted - filled and rounds < _ROUNDS and not last_call:
            for part, some in came.items():
                self.later.updateValue((part, rounds), (json.dumps(some),))
            self.open.update((expected, wanted, filled, last, stale, strays, first_stray, deadline,
                              put_off + len(events), rounds + 1))
            return
        before: dict[int, list] = {part: [] for part in came}
        for part, n in sorted(tuple(k) for k in self.later.keys()) if put_off else ():
            before.setdefault(part, []).append(n)
        unannounced = []
        for part, some_rounds in before.items():
            some = [tuple(e) for n in some_rounds for e in json.loads(self.later.getValue((part, n))[0])]
            some += came.get(part, ())
            slots = self._unpacked(self.slots.getValue((part,)))
            changed = False
            for e in some:
                trade_id, arrival = e[0], e[1]
                held = slots.get(trade_id)
                if held is None:
                    unannounced.append(e)
                    first_stray = arrival if first_stray is None else min(first_stray, arrival)
                    continue
                if held[0] == _AWAITED:
                    filled += 1
                elif arrival > held[0]:
                    yield self._event(group, e, DUPLICATE)
                    continue
                else:
                    yield self._event(group, (trade_id, *held), DUPLICATE)
                    stale = stale or held[0] == last
                last = arrival if last is None else max(last, arrival)
                slots[trade_id] = tuple(e[1:])
                changed = True
            if changed:
                self._hold(part, slots)
        for part, some in _by_part({e[0] for e in unannounced}, _STRAY_PARTS).items():
            seen = self.stray_ids.getValue((part,))
            known = set(seen[0]) if seen is not None else set()
            fresh = [i for i in some if i not in known]
            if fresh:
                self.stray_ids.updateValue((part,), ([*known, *fresh],))
                strays += len(fresh)
        if unannounced:
            self.strays.appendList(unannounced)
        if put_off:
            self.later.clear()
        self.open.update((expected, wanted, filled, last, stale, strays, first_stray, deadline, 0, 0))

    @staticmethod
    def _event(group: str, e: tuple, outcome: str | None, kind: str = EVENT,
               reason: str | None = None) -> Row:
        return _Decision(kind, group, e[0], e[3], e[1], e[2], outcome, reason, None, None, None, None)

    def _received(self) -> Iterator[tuple]:
        for _, held in self.slots.iterator():
            for trade_id, v in self._unpacked(held).items():
                if v[0] != _AWAITED:
                    yield (trade_id, *v)

    def _settle(self, group: str) -> Iterator[Row]:
        """Close the group if it is whole."""
        (expected, wanted, filled, last, stale, strays, first_stray, deadline, put_off,
         rounds) = self.open.get()
        if not wanted or expected != wanted or filled < wanted:
            return
        if stale:
            # The event that was last has given way to an earlier one of its id.
            last = max(e[1] for e in self._received())
            self.open.update((expected, wanted, filled, last, False, strays, first_stray, deadline,
                              put_off, rounds))
        if first_stray is not None and first_stray < last:
            return
        for e in self._received():
            yield self._event(group, e, SUCCESS)
        yield _row(kind=GROUP, trade_group_id=group, arrival=last, status=GROUP_SUCCESS,
                   expected_count=expected, actual_count=wanted, missing_count=0)
        if strays:
            # Later than the completion: they find no control document any more.
            for e in self.strays.get():
                yield self._event(group, tuple(e), DLQ_ROUTED, reason=NO_CONTROL_DOC)
        self.handle.deleteTimer(deadline)
        self._forget()
        until = deadline - self.timeout_ms + self.closed_ttl_ms
        self.closed.update((until,))
        self.handle.registerTimer(until)

    def _forget(self) -> None:
        for state in (self.open, self.slots, self.later, self.strays, self.stray_ids):
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        group, moment = key[0], expiredTimerInfo.getExpiryTimeInMs()
        if self.open.exists() and self.open.get()[_DEADLINE] <= moment:
            yield from self._fail(group)
        held = self.dues.getValue((moment,))
        if held is not None:
            for events in self._parts(moment, held[0]):
                for e in events:
                    yield self._event(group, e, DLQ_ROUTED, reason=NO_CONTROL_DOC)
        if self.closed.exists() and self.closed.get()[0] <= moment:
            self.closed.clear()

    def _fail(self, group: str) -> Iterator[Row]:
        yield from self._fill(group, [], last_call=True)
        expected, wanted, filled, _, _, strays, *_ = self.open.get()
        yield _row(kind=GROUP, trade_group_id=group, outcome=DLQ_ROUTED,
                   failure_reason=BATCH_TIMEOUT, status=GROUP_FAIL, expected_count=expected,
                   actual_count=filled + strays, missing_count=wanted - filled)
        for e in self._received():
            yield self._event(group, e, None, INCOMPLETE)
        if strays:
            for e in self.strays.get():
                yield self._event(group, tuple(e), None, UNANNOUNCED)
        self._forget()


class EventTimeGroupProcessor(GroupProcessor):
    """The same on event time: waits and deadlines count from a record's own time and end
    when the watermark has passed, so that runs can be repeated. What comes after its own
    wait has passed is decided at once."""

    event_time = True


class _Packed:
    """A processor whose rows come and go packed (see ``packs``)."""

    made: Row

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return pack_rows(super().handleInputRows(key, unpack_rows(rows), timerValues), self.made)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return pack_rows(super().handleExpiredTimer(key, timerValues, expiredTimerInfo), self.made)


class PackedKeyMarks(_Packed, KeyMarks):
    made = _Marked


class PackedGroups(_Packed, GroupProcessor):
    made = _Decision


class PackedEventTimeGroups(_Packed, EventTimeGroupProcessor):
    made = _Decision
