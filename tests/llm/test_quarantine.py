import zlib
from collections import Counter

import duckdb
import pytest

from linkflow.llm import quarantine, queries


def plain(rows):
    """Turn by turn, attempt by attempt."""
    by, out = {}, Counter()
    for conv, turn, text in rows:
        by.setdefault(conv, []).append((turn, zlib.crc32((text or "").encode())))
    shown = lambda v: "" if v is None else str(v)
    for conv, turns in by.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        done = []
        for p, (turn, _) in enumerate(turns):
            h = lambda k: zlib.crc32(f"{k}:{shown(conv)}:{shown(turn)}".encode())
            back = h(0) % 5
            parent = done[p - back] if 0 < back <= p else None
            if parent is not None and parent[0] != "delivered":
                done.append(("blocked", 0, None, None))
                continue
            first = at = max(7 * p, parent[3] if parent else 0)
            for a in range(1, 7):
                if not h(1) % 101 < 50 or (at >= 7 * p + h(2) % 101 and h(a + 2) % 3):
                    done.append(("delivered", a, first, at))
                    break
                if a == 6:
                    done.append(("dead", 6, first, at))
                at += 20 * 2 ** (a - 1)
        released = sorted((i for i in range(len(turns)) if done[i][0] == "delivered"), key=lambda i: (done[i][3], i))
        number, state, total = {}, {}, 0
        for k, i in enumerate(released, 1):
            total += k * turns[i][1]
            number[i], state[i] = k, (total + 2**63) % 2**64 - 2**63
        out.update((conv, turn, *done[i], number.get(i), state.get(i)) for i, (turn, _) in enumerate(turns))
    return out


CASES = {
    "empty": [],
    "odd": [(None, None, None), (None, 3, ""), (1, None, "x"), (2, -5, None), (2, 10**15, "é" * 9000), (2, 10**15, "y")],
    "short": [(c, t, f"text {c} {t}") for c in range(300) for t in range(c % 9)],
    "long": [(7, 3 * i - 500, f"t{i}") for i in range(3000)] + [(8, 0, "other")],
    "copies": [(1, 1, "a"), (1, 1, "a"), (1, 1, "b")] + [(3, i % 3, "z") for i in range(2000)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("halo", [0, quarantine.HALO])
def test_against_a_plain_replay(spark, name, halo):
    df = spark.createDataFrame([(*r, 1, 2) for r in CASES[name]], "conv_id long, turn long, text string, status int, g int")
    got = quarantine.replayed(df, halo)
    assert got.columns == ["conv_id", "turn", "status", "attempts", "first_at", "last_at", "release_no", "state"]
    assert Counter(map(tuple, got.collect())) == plain(CASES[name])


def test_query_against_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from '{d}/conversations.parquet'")
    want = c.sql(queries.oracle_sql()["op13_quarantine"])
    got = queries.op13_quarantine(spark, d)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
