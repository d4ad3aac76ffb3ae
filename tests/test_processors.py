"""Stateful processors on plain rows: what one group costs in calls to the state."""

from pyspark.sql import Row

from mentionlake.streaming import passes, trees


class Clock:
    def getCurrentWatermarkInMs(self):
        return 0


class State:
    def __init__(self, calls):
        self.calls, self.rows = calls, []

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            if name in ("update", "appendList"):
                self.rows = [given[0]] if name == "update" else self.rows + given[0]
            elif name == "clear":
                self.rows = []
            return bool(self.rows) if name == "exists" else self.rows
        return call


class Value(State):
    def get(self):
        self.calls.append("get")
        return self.rows[0] if self.rows else None


class Handle:
    def __init__(self):
        self.calls = []

    def getValueState(self, name, schema):
        return Value(self.calls)

    def getListState(self, name, schema):
        return State(self.calls)

    def registerTimer(self, moment):
        self.calls.append("timer")


def test_a_reply_that_waits_costs_three_calls_and_its_answer_comes_as_rows():
    handle, processor = Handle(), trees.AnswerProcessor()
    processor.init(handle)
    reply = Row(key="a", id="b", post_id="p", created=5_000_000, top=None)
    assert list(processor.handleInputRows(("a",), iter([reply]), Clock())) == []
    assert handle.calls == ["get", "appendList", "timer"]
    known = Row(key="a", id="a", post_id="p", created=0, top=0)
    (found,) = processor.handleInputRows(("a",), iter([known]), Clock())
    assert (found.id, found.created, found.top) == ("b", 5_000_000, 0) and len(handle.calls) == 8


def test_a_post_costs_four_calls_and_its_pass_comes_as_rows():
    handle, processor = Handle(), passes.PassProcessor()
    processor.init(handle)
    list(processor.handleInputRows(("a",), iter([Row(id="a", created_ms=0)]), Clock()))
    assert handle.calls == ["exists", "update", "timer", "timer"]
    expired = type("Expired", (), {"getExpiryTimeInMs": lambda self: 55 * 60_000})()
    (due,) = processor.handleExpiredTimer(("a",), Clock(), expired)
    assert (due["id"], due["pass"]) == ("a", "1h")
