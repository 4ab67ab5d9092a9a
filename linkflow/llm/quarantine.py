"""Quarantine and cascading release: conversations are replayed, many at once, position by position.

Turn ``p`` of a conversation arrives at second ``7 * p``. Its parent lies up to four turns before it.
Faulty turns are quarantined: they are tried again with growing pauses until they are repaired or
have failed too often; a turn waits for its parent's delivery, and a turn whose parent is dead or
blocked is blocked. Delivered turns are numbered in the order of delivery, with a running state.

Method: conversations are cut into blocks of ``BLOCK`` turns by exact places (``ranks``). A task packs
all its blocks into ragged numpy columns, longest block first, and advances all of them together:
at each position it gathers the parents' outcomes and evaluates the attempts by masks. A block also
holds the last ``HALO`` turns before it; links of more turns are rare. A turn whose parent's outcome
is not known stays open; blocks with open turns are done again, with what is known of the block
before, until none is open. Every pass closes at least the first open block of a conversation.

A conversation is never one task's work: places, release numbers and states come from hierarchical
counts and sums. The driver gets single numbers (the largest group, the count of open turns).

Defined results: turns are ordered by turn (null first), equal ones by the crc32 of their texts; each
is a turn of its own, and exact copies are too; a null conv_id is a conversation of its own; a null
conv_id or turn is hashed as the empty text; null text counts as empty; ``state`` keeps 64 bits
(two's complement); what does not apply is null; an empty table gives an empty table; other columns,
whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import batch, release, save
from linkflow.llm.ranks import hex_key, ranked, running_sums

# The rules of the replay.
GAP, REACH, ATTEMPTS, PAUSE = 7, 5, 6, 20
FAULTY, OUT_OF, FAILS = 50, 101, 3
BLOCK_BITS, HALO = 8, 64
#: Rows that are packed together, at least.
PACK = 50_000

DELIVERED, DEAD, BLOCKED, OPEN = range(4)
STATUS = ("delivered", "dead", "blocked")
#: Seconds from the first attempt to each attempt.
_OFFSETS = np.array([PAUSE * (2**a - 1) for a in range(ATTEMPTS)], np.int64)

_TURN = "g string, conv_id long, turn long, crc long, p long, block long, distance int, repaired long, fails int"
_DONE = "status int, attempts int, first_at long, last_at long"
_IN = [c.split()[0] for c in (_TURN + ", " + _DONE).split(", ")]
_OUT = pa.schema(
    [("g", pa.string()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("crc", pa.int64()), ("p", pa.int64()), ("block", pa.int64()), ("distance", pa.int32()), ("repaired", pa.int64()),
     ("fails", pa.int32()), ("status", pa.int32()), ("attempts", pa.int32()), ("first_at", pa.int64()), ("last_at", pa.int64())]
)


def turns(conversations: DataFrame) -> DataFrame:
    """Each turn with its place and the facts that its hashes say: ``_TURN`` but ``block``, and the conversation's ``total``; saved."""
    crc = lambda x: F.crc32(x.cast("binary"))
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("g"), "conv_id", "turn", crc(F.coalesce("text", F.lit(""))).alias("crc"))
    rows = save(rows.withColumn("key", F.concat(hex_key(F.col("turn")), F.lpad(F.hex("crc"), 8, "0"))), "release-turns")
    placed = ranked(rows, ["g"], "key")
    release(rows)
    name = F.coalesce(F.col("turn").cast("string"), F.lit(""))
    h = lambda k: crc(F.concat(F.lit(f"{k}:"), "g", F.lit(":"), name))
    fails = sum((F.when(h(a + 2) % FAILS == 0, 1 << (a - 1)).otherwise(0) for a in range(2, ATTEMPTS + 1)), F.when(h(3) % FAILS == 0, 1).otherwise(0))
    repaired = F.when(h(1) % OUT_OF < FAULTY, GAP * F.col("idx") + h(2) % OUT_OF)
    out = save(placed.select("g", "conv_id", "turn", "crc", F.col("idx").alias("p"), (h(0) % REACH).cast("int").alias("distance"), repaired.alias("repaired"), fails.cast("int").alias("fails"), "total"), "release-facts")
    return out


def replay(cols: dict[str, np.ndarray], starts: np.ndarray) -> None:
    """Evaluates ragged blocks in place.

    ``cols`` are the columns of blocks that lie one after another, ``starts`` their first rows. A row
    whose status is given keeps it.
    """
    n = len(cols["p"])
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    # So many blocks are longer than t.
    longer = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), side="right")
    p, distance, repaired, fails = cols["p"], cols["distance"], cols["repaired"], cols["fails"]
    status, attempts, first, last = cols["status"], cols["attempts"], cols["first_at"], cols["last_at"]
    for t, k in enumerate(longer):
        at = starts[:k] + t
        at = at[status[at] < 0]
        d = distance[at]
        has = (d > 0) & (p[at] >= d)
        # A parent before the block's rows is not known; one of the rows lies as far back as its distance.
        parent = np.where(has, at - d, at)
        inside = ~has | (d <= cols["local"][at])
        parent = np.where(inside, parent, at)
        ps = np.where(has & inside, status[parent], DELIVERED)
        unknown = ~inside | (has & (ps == OPEN))
        held = has & ~unknown & (ps != DELIVERED)
        begin = np.maximum(GAP * p[at], np.where(has & inside & (ps == DELIVERED), last[parent], 0))
        times = begin[:, None] + _OFFSETS
        fixed = repaired[at]
        failed = (fixed >= 0)[:, None] & ((times < fixed[:, None]) | ((fails[at][:, None] >> np.arange(ATTEMPTS)) & 1 == 1))
        dead = failed.all(axis=1)
        tries = np.where(dead, ATTEMPTS, failed.argmin(axis=1) + 1)
        status[at] = np.where(unknown, OPEN, np.where(held, BLOCKED, np.where(dead, DEAD, DELIVERED)))
        attempts[at] = np.where(unknown | held, 0, tries)
        first[at] = begin
        last[at] = times[np.arange(len(at)), tries - 1]


def _pass(rows: DataFrame) -> DataFrame:
    """One pass over blocks: rows of ``_IN`` with outcomes where they are known, and those of the halo before each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(t: pa.Table) -> pa.RecordBatch:
            cols = {}
            for c in ("p", "block", "distance", "repaired", "fails", "status", "attempts", "first_at", "last_at"):
                cols[c] = t[c].combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False).copy()
            g = t["g"].combine_chunks().dictionary_encode().indices.to_numpy()
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (cols["block"][1:] != cols["block"][:-1])
            starts = np.flatnonzero(new)
            cols["local"] = np.arange(len(g)) - starts[np.cumsum(new) - 1]
            replay(cols, starts)
            own = cols["p"] >> BLOCK_BITS == cols["block"]
            keep = pa.array(own)
            no = (cols["status"] == BLOCKED) | (cols["status"] == OPEN)
            time = lambda c: pa.array(cols[c], mask=no).filter(keep)
            plain = [t[c].combine_chunks().filter(keep) for c in _IN[:9]]
            return batch(_OUT, *plain, pa.array(cols["status"].astype(np.int32)).filter(keep), pa.array(cols["attempts"].astype(np.int32)).filter(keep), time("first_at"), time("last_at"))

        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < PACK:
                continue
            held = held.combine_chunks()
            # The last block may go on in the next batch.
            g, block = held["g"].to_numpy(zero_copy_only=False), held["block"].to_numpy()
            change = np.flatnonzero((g[1:] != g[:-1]) | (block[1:] != block[:-1]))
            if len(change):
                cut = int(change[-1]) + 1
                yield done(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield done(held)

    dealt = rows.select(*_IN).repartition("g", "block").sortWithinPartitions("g", "block", "p")
    return dealt.mapInArrow(run, f"{_TURN}, {_DONE}")


def outcomes(placed: DataFrame, halo: int = HALO) -> DataFrame:
    """Every turn of ``turns()`` with its outcome (``_IN``)."""
    block = F.shiftright("p", BLOCK_BITS)
    none = {c: F.lit(None).cast(t) for c, t in (x.split() for x in _DONE.split(", "))}
    rows = placed.withColumn("block", block).withColumns(none)
    size = 1 << BLOCK_BITS
    # The last turns of a block that has a next one stand before that one, too.
    before = rows.where((F.col("p") % size >= size - halo) & ((F.col("block") + 1) * size < F.col("total"))).withColumn("block", F.col("block") + 1)
    now = save(_pass(rows.unionByName(before)), "release-pass")
    closed = []
    while not (open_turns := now.where(F.col("status") == OPEN)).isEmpty():
        # Blocks with open turns are done again, with the known outcomes of the turns before them.
        again = open_turns.select("g", "block").distinct()
        mine = now.join(again, ["g", "block"], "left_semi")
        rest = save(now.join(again, ["g", "block"], "left_anti"), "release-closed")
        everything = now
        for c in closed:
            everything = everything.unionByName(c)
        last = everything.where((F.col("p") % size >= size - REACH + 1) & (F.col("status") != OPEN)).withColumn("block", F.col("block") + 1)
        mine = mine.withColumn("status", F.when(F.col("status") != OPEN, F.col("status"))).unionByName(last.join(again, ["g", "block"], "left_semi"))
        closed.append(rest)
        after = save(_pass(mine), "release-pass")
        release(now)
        now = after
    for c in closed:
        now = now.unionByName(c)
    return now


def wrapped(x: Column) -> Column:
    """A non-negative whole decimal as the long of its lowest 64 bits."""
    whole = lambda bits: F.lit(str(1 << bits)).cast("decimal(38,0)")
    rest = F.pmod(x, whole(64))
    return F.when(rest >= whole(63), rest - whole(64)).otherwise(rest).cast("long")


def replayed(conversations: DataFrame, halo: int = HALO) -> DataFrame:
    """Per turn ``conv_id, turn, status, attempts, first_at, last_at, release_no, state``."""
    placed = turns(conversations)
    got = outcomes(placed, halo)
    columns = ["conv_id", "turn", "status", "attempts", "first_at", "last_at"]
    named = F.element_at(F.array(*map(F.lit, STATUS)), F.col("status") + 1)
    delivered = got.where(F.col("status") == DELIVERED).select("g", *columns, "crc", F.concat(hex_key(F.col("last_at")), hex_key(F.col("p"))).alias("key"))
    delivered = ranked(save(delivered, "release-delivered"), ["g"], "key")
    release_no = F.col("idx") + 1
    delivered = running_sums(delivered, ["g"], release_no.cast("decimal(18,0)") * F.col("crc").cast("decimal(10,0)"))
    out = delivered.select(*columns, release_no.alias("release_no"), wrapped(F.col("running")).alias("state"))
    none = F.lit(None).cast("long")
    held = got.where(F.col("status") != DELIVERED).select(*columns, none.alias("release_no"), none.alias("state"))
    return out.unionByName(held).withColumn("status", named)


_CRC = "xor(list_reduce(list_transform(range(0, length({x})//2), lambda i: ('0x'||substr({x}, 2*i+1, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
_HASHES = ", ".join(f"{_CRC.format(x=f'k{k}')} AS h{k}" for k in range(ATTEMPTS + 3))
_KEYS = ", ".join(f"hex(encode('{k}:'||conv||':'||name)) AS k{k}" for k in range(ATTEMPTS + 3))
_FAILS = ", ".join(f"h{a + 2} % {FAILS} = 0" for a in range(1, ATTEMPTS + 1))
#: The attempt that delivers (null: none does), if the first comes at ``{begin}``.
_TRY = f"list_filter(range(1, {ATTEMPTS + 1}), lambda a: repaired IS NULL OR ({{begin}} + {PAUSE} * ((1 << (a - 1)) - 1) >= repaired AND NOT fails[a]))[1]"
ORACLE = f"""WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
keyed AS (SELECT conv_id, turn, conv, hex(encode(coalesce(text,''))) AS body, {_KEYS} FROM (SELECT *, coalesce(conv_id::VARCHAR,'') AS conv, coalesce(turn::VARCHAR,'') AS name FROM conversations)),
hashed AS (SELECT conv_id, turn, conv, CASE WHEN body = '' THEN 0 ELSE {_CRC.format(x='body')} END AS crc, {_HASHES} FROM keyed, tab),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, crc) - 1 AS p, h0 % {REACH} AS distance FROM hashed),
facts AS (SELECT conv_id, turn, conv, crc, p, CASE WHEN distance > 0 AND p >= distance THEN p - distance END AS parent, {GAP} * p AS arrival,
    CASE WHEN h1 % {OUT_OF} < {FAULTY} THEN {GAP} * p + h2 % {OUT_OF} END AS repaired, [{_FAILS}] AS fails FROM placed),
ends AS (
    SELECT conv, p, 'x' AS status, arrival AS first_at, {_TRY.format(begin='arrival')} AS tried FROM facts WHERE parent IS NULL
    UNION ALL
    SELECT f.conv, f.p, CASE WHEN e.status = 'blocked' OR e.tried IS NULL THEN 'blocked' ELSE 'x' END, greatest(f.arrival, e.first_at + {PAUSE} * ((1 << (e.tried - 1)) - 1)),
        CASE WHEN e.status = 'x' AND e.tried IS NOT NULL THEN {_TRY.format(begin=f'greatest(f.arrival, e.first_at + {PAUSE} * ((1 << (e.tried - 1)) - 1))')} END
    FROM ends e JOIN facts f ON f.conv = e.conv AND f.parent = e.p),
done AS (SELECT conv, p, CASE WHEN status = 'blocked' THEN status WHEN tried IS NULL THEN 'dead' ELSE 'delivered' END AS status,
    CASE WHEN status = 'blocked' THEN 0 ELSE coalesce(tried, {ATTEMPTS}) END AS attempts, CASE WHEN status <> 'blocked' THEN first_at END AS first_at FROM ends),
timed AS (SELECT f.conv_id, f.turn, f.conv, f.p, f.crc, d.status, d.attempts, d.first_at, CASE WHEN d.attempts > 0 THEN d.first_at + {PAUSE} * ((1 << (d.attempts - 1)) - 1) END AS last_at
    FROM facts f JOIN done d USING (conv, p)),
numbered AS (SELECT *, CASE WHEN status = 'delivered' THEN row_number() OVER (PARTITION BY conv, status ORDER BY last_at, p) END AS release_no FROM timed)
SELECT conv_id, turn, status, attempts::INT AS attempts, first_at::BIGINT AS first_at, last_at::BIGINT AS last_at, release_no::BIGINT AS release_no,
    CASE WHEN status = 'delivered' THEN sum(release_no * crc) OVER (PARTITION BY conv, status ORDER BY release_no) END::BIGINT AS state FROM numbered"""
