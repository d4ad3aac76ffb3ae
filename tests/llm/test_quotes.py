"""Quotation links on small conversations and against SQL on generated ones."""

import random

import duckdb
import pytest

from mentionlake.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, thread int, level int"


def part(rng, line):
    words = line.split()
    start = rng.randrange(len(words))
    return " ".join(words[start:rng.choice([len(words), start + 3])])


def linked(frame, rows):
    df = frame([(*r, 1, 2) for r in rows], SCHEMA)
    return {(r["conv_id"], r["turn"]): r for r in quotes.link(df).collect()}


def test_nested_levels_and_threads(frame):
    out = linked(frame, [
        (1, 0, "user", "How do I start?\nSecond point"),
        (1, 1, "assistant", "Open the door"),
        (1, 2, "user", "> open  THE door\n>> How do I start?\nWhich one?"),
        (1, 3, "assistant", "> Second point\nIgnore that"),
        (1, 4, "user", "fine"),
        (1, 5, "user", "> nothing like it\n>> Which one?\nhm"),
        (2, 0, "user", "> Open the door\nother conversation"),
        (2, 7, None, None),
        (None, 1, "user", "x"), (3, None, "user", "x"),
    ])
    assert len(out) == 10
    got = {k: (r["parent_turn"], r["linked"], r["n_quoted"], r["thread"], r["text"]) for k, r in out.items()}
    assert got[1, 2] == (1, False, 2, 0, "Which one?")
    assert got[1, 3] == (0, True, 1, 3, "Ignore that")
    assert got[1, 4] == (3, False, 0, 3, "fine")
    assert got[1, 5] == (2, True, 2, 5, "hm")
    assert got[2, 0] == (None, False, 1, 0, "other conversation")
    assert got[2, 7] == (0, False, 0, 0, "") and out[2, 7]["formatted"] == "<||>\n"
    assert got[None, 1] == (None, False, 0, 1, "x") and got[3, None] == (None, False, 0, None, "x")
    assert quotes.link(frame([], SCHEMA)).count() == 0


def test_parts_of_lines_and_quotes_wrapped_anew(frame):
    said = "The first thing to try is to open the small door behind the stairs, and then to wait until it is dark."
    out = linked(frame, [
        (1, 1, "user", "hello there\n" + said),
        (1, 2, "assistant", "something else"),
        (1, 3, "user", "> Hello\nhi"),
        (1, 5, "assistant", "> The first thing to try is to open the small\n> door behind the\n>   stairs, and then to wait\nwhy"),
        (1, 9, "user", "> then to wait until it is\n> light\nno"),
        (1, 12, "user", "after a gap"),
        (1, 13, "user", "> hell\nnot a word of it"),
    ])
    got = {k[1]: (r["parent_turn"], r["linked"], r["n_quoted"], r["thread"]) for k, r in out.items()}
    assert got == {
        1: (None, False, 0, 1), 2: (1, False, 0, 1), 3: (1, True, 1, 3), 5: (1, True, 3, 5), 9: (1, True, 2, 9),
        12: (9, False, 0, 9), 13: (12, False, 1, 9)}


def test_every_row_is_kept(frame):
    rows = [
        (1, 0, "user", "one"), (1, 0, "assistant", "two"), (1, 0, "user", "one"), (1, 1, "user", "> two\nthree"),
        (1, None, "user", "> one\nx"), (1, None, "user", "> one\nx"), (None, None, None, None),
    ]
    out = quotes.link(frame([(*r, 1, 2) for r in rows], SCHEMA)).collect()
    assert len(out) == len(rows)
    assert sum(r["text"] == "one" for r in out) == 2 and sum(r["text"] == "x" for r in out) == 2
    answer, = (r for r in out if r["text"] == "three")
    assert (answer["parent_turn"], answer["linked"], answer["thread"]) == (0, False, 0)


def test_copies_by_blocks_and_very_long_texts(frame, monkeypatch):
    monkeypatch.setattr(quotes, "BLOCK", 3)
    long = " ".join(f"w{i}" for i in range(100_000))
    rows = [(1, 0, "user", long)] + [(1, 1, "user", "between")] * 7 + [(1, 2, "user", f"> {long[300_000:300_900]}\nend")]
    out = quotes.link(frame([(*r, 1, 2) for r in rows], SCHEMA)).collect()
    assert len(out) == 9 and {r["parent_turn"] for r in out if r["turn"] == 2} == {0}


def test_sql_agrees_on_generated_conversations(frame):
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        said = []
        for turn in range(rng.choice([1, 5, 40, 300])):
            own = [" ".join(f"w{rng.randint(0, 9)}" for _ in range(rng.choice([1, 3, 12, 20]))) for _ in range(rng.randint(0, 3))]
            quoted = [f"{'>' * rng.randint(1, 3)} {part(rng, rng.choice(said))}" for _ in range(rng.randint(0, 2)) if said]
            said += own
            at = rng.choice([turn * 2, turn * 2, turn, None]) if conv % 2 else turn
            row = (conv if conv else None, at, rng.choice(["user", "assistant", None]), rng.choice(["\n", "\r\n"]).join(quoted + own))
            rows += [row] * rng.choice([1, 1, 1, 2])
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.sql(quotes.ORACLE)
    df = quotes.link(frame([(*r, 1, 2) for r in rows], SCHEMA))
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    got = sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(str, want.select(", ".join(f'"{c}"' for c in columns)).fetchall()))


@pytest.mark.parametrize("turns", [700])
def test_long_chain(frame, turns):
    out = linked(frame, [(1, t, "user", f"t {t}") for t in range(turns)])
    assert {r["thread"] for r in out.values()} == {0}
