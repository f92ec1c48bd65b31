"""Repair of damaged conversations at least cost, with the least audit among the cheapest.

A conversation is its rows by turn (NULL first; rows of one turn by role and a hash of the text). Faults: *blank* (no character but ASCII white space), *duplicate* (role and text
seen earlier), *truncated* (the last other character is none of ``.!?``); a row's first fault counts. Edits have an initial each: Delete (4; demanded for blank
and duplicate rows), Insert a row with empty text (3), Keep (0) and Rerole to user or assistant (3); a truncated row that stays adds 3. The roles left
have the initials ``(s?(ua)+)?``. The audit is the edits' initials in order; of the cheapest audits the ASCII-least counts.

Costs are found backwards over nodes (row, state), the states being: nothing yet, after s, after u, after a. Arcs that
lie on a cheapest way are optimal; at most one arc of each initial leaves a node. Prefix doubling ranks the nodes: by the initial of the least audit
first, then by audits of 2, 4, 8 ... edits, each level from the ranks of the level before at the node and at its pointer, which
then is doubled. Ranks settle the arc that a node takes, and the doubled pointers list the nodes of a whole way at once.

A conversation may hold any share of the rows. Equal rows are counted first (all but one of them go). Rows, as codes without
texts, are range-partitioned by conversation and order and cut into pieces of at most ``BLOCK`` rows. A piece is a small matrix of
costs from state to state; the pieces of a conversation are chained through these matrices, backwards for costs
and forwards for states. Only the hash of a repaired conversation is taken in one run, over rows that stream by in order: SHA-256 can't be joined from parts.

NULL values count as one space, a NULL conv_id being a conversation of its own. Extra columns are ignored. A conversation that lost all its
rows stays with empty results. Rows of one conversation with one turn, role and text are equal rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from . import files

#: Rows of a piece, and rows that are solved at once.
BLOCK = 4096
_BATCH = 1 << 16
#: Costs, and the state after an inserted or reroled row, by state.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
_NEXT = np.array([2, 2, 3, 2])
_INITIALS = np.frombuffer(b"DIKR\0", dtype=np.uint8)
_FAR = 1 << 40
_FIRST = -(1 << 63)

KEY = ["conv", "t", "role", "h1", "h2"]
_KEY_TYPES = "conv string, t long, role string, h1 long, h2 long"
PIECES = f"{_KEY_TYPES}, part long, block long, whole boolean, codes binary, extras binary, matrix array<long>, audit string, stats array<long>"


def _space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, times)``: conversations damaged by the CRC-32 of ``conv_id:turn``; rows that are dropped have 0 ``times``."""
    kind = F.crc32(F.concat(_space("conv_id"), F.lit(":"), _space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(_space("text"), "[.!?]", "")).otherwise(_space("text"))
    role = F.when(kind == 4, "user").otherwise(_space("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.alias("times"))


# Costs and optimal arcs of a batch of pieces. Shorter pieces are padded in front; nothing leads there.


def _costs(codes: np.ndarray, end: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """Least costs from (row, state) to the end: ``(pieces, rows + 1, 4)``. ``closed`` pieces may insert rows at their end."""
    count, length = codes.shape
    cost = np.empty((count, length + 1, 4), dtype=np.int64)
    cost[:, length] = np.where(closed[:, None], _inserted(end), end)
    initial, must, cut = codes & 3, (codes & 12) > 0, TRUNCATED * ((codes & 16) > 0)
    for at in range(length - 1, -1, -1):
        after = cost[:, at + 1]
        stays = np.where(must[:, at], _FAR, cut[:, at])[:, None]
        here = np.minimum(after + DELETE, after[:, _NEXT] + stays + REROLE)
        for state, wanted in enumerate(_KEEPS):
            for letter, target in wanted:
                fits = np.where(initial[:, at] == letter, after[:, target] + stays[:, 0], _FAR)
                here[:, state] = np.minimum(here[:, state], fits)
        cost[:, at] = _inserted(here)
    return cost


#: By state: the initials (1 s, 2 u, 3 a) that may be kept, and the state after them.
_KEEPS = (((1, 1), (2, 2)), ((2, 2),), ((3, 3),), ((2, 2),))
_KEPT = np.full((4, 4), -1)
for _state, _wanted in enumerate(_KEEPS):
    for _letter, _target in _wanted:
        _KEPT[_state, _letter] = _target


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Costs if rows may be inserted first."""
    user = np.minimum(cost[:, 2], cost[:, 3] + INSERT)
    out = np.minimum(cost, user[:, None] + INSERT)
    out[:, 2] = user
    out[:, 3] = np.minimum(cost[:, 3], cost[:, 2] + INSERT)
    return out


def _arcs(codes: np.ndarray, cost: np.ndarray, end: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Optimal arcs as ``(kinds, nodes)`` arrays: whether the arc of initial D, I, K, R is optimal, and its target node. Nodes are numbered by piece, row, state."""
    count, length = codes.shape
    node = np.arange(cost.size).reshape(cost.shape)
    optimal = np.zeros((4, *cost.shape), dtype=bool)
    target = np.broadcast_to(node, optimal.shape).copy()
    now, after, here, then = cost[:, :-1], cost[:, 1:], node[:, :-1], node[:, 1:]
    stays = np.where((codes & 12) > 0, _FAR, TRUNCATED * ((codes & 16) > 0))[:, :, None]
    optimal[0, :, :-1], target[0, :, :-1] = now == after + DELETE, then
    optimal[1], target[1] = cost == cost[:, :, _NEXT] + INSERT, node[:, :, _NEXT]
    optimal[1, :, length] &= closed[:, None] & (cost[:, length] < end)
    kept = _KEPT.T[codes & 3]
    can = kept >= 0
    optimal[2, :, :-1] = can & (now == np.take_along_axis(after, np.maximum(kept, 0), 2) + stays)
    target[2, :, :-1] = np.take_along_axis(then, np.maximum(kept, 0), 2)
    optimal[3, :, :-1], target[3, :, :-1] = now == after[:, :, _NEXT] + stays + REROLE, then[:, :, _NEXT]
    return optimal.reshape(4, -1), target.reshape(4, -1)


def _ranked(optimal: np.ndarray, target: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Initial of each node's best arc (4 where the way ends), and the pointers 1, 2, 4 ... edits ahead."""
    nodes = np.arange(optimal.shape[1])
    ends = ~optimal.any(axis=0)
    letter = np.where(ends, 4, optimal.argmax(axis=0))
    # The end of a way comes before all initials, as a shorter audit before a longer one.
    rank = np.where(ends, 0, letter + 1)
    pointer = np.where(ends, nodes, target[letter % 4, nodes])
    pointers = [pointer]
    for _ in range(max(1, longest).bit_length()):
        _, rank = np.unique(rank * (len(nodes) + 5) + rank[pointer], return_inverse=True)
        pointer = pointer[pointer]
        pointers.append(pointer)
    choice = np.where(optimal, np.arange(4)[:, None] * (len(nodes) + 5) + rank[target], 5 * (len(nodes) + 5)).argmin(axis=0)
    return np.where(ends, 4, choice), pointers


def _ways(codes: np.ndarray, cost: np.ndarray, end: np.ndarray, closed: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Audits from the start nodes, and the nodes where they end."""
    letter, pointers = _ranked(*_arcs(codes, cost, end, closed), 2 * codes.shape[1] + 4)
    way = starts[:, None]
    for pointer in reversed(pointers[:-1]):
        way = np.stack((way, pointer[way]), axis=2).reshape(len(starts), -1)
    letters = _INITIALS[letter[way]]
    return [row.tobytes().rstrip(b"\0") for row in letters], pointers[-1][starts]


def _padded(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The codes, aligned at their ends, and the row where each piece begins."""
    length = max(map(len, pieces))
    out = np.full((len(pieces), length), 4, dtype=np.int64)
    for row, codes in zip(out, pieces):
        row[length - len(codes) :] = codes
    return out, length - np.array([len(codes) for codes in pieces])


def _batches(sizes: list[int]) -> Iterator[list[int]]:
    """Numbers of pieces of like sizes, at most ``_BATCH`` padded rows together."""
    group: list[int] = []
    for k in sorted(range(len(sizes)), key=sizes.__getitem__):
        if group and (len(group) + 1) * sizes[k] > _BATCH or group and sizes[k] > 2 * sizes[group[0]] + 8:
            yield group
            group = []
        group.append(k)
    if group:
        yield group


_ACCEPT = np.array([0, _FAR, _FAR, 0])


def solve(pieces: list[np.ndarray]) -> tuple[list[int], list[bytes]]:
    """Cost and audit of whole conversations, given by the codes of their rows."""
    costs, audits = [0] * len(pieces), [b""] * len(pieces)
    for group in _batches([len(p) for p in pieces]):
        codes, begin = _padded([pieces[k] for k in group])
        end, closed = np.tile(_ACCEPT, (len(group), 1)), np.ones(len(group), dtype=bool)
        cost = _costs(codes, end, closed)
        starts = np.arange(len(group)) * cost[0].size + begin * 4
        found, _ = _ways(codes, cost, end, closed, starts)
        for k, audit, value in zip(group, found, cost.reshape(-1)[starts].tolist()):
            costs[k], audits[k] = value, audit
    return costs, audits


def matrix(codes: np.ndarray) -> np.ndarray:
    """Least costs of a piece from each state before it to each state after it."""
    ends = np.where(np.eye(4, dtype=bool), 0, _FAR)
    return _costs(np.repeat(codes[None].astype(np.int64), 4, axis=0), ends, np.zeros(4, dtype=bool))[:, 0].T


def _with_extras(audit: bytes, extras: np.ndarray) -> str:
    """The audit with a Delete for every further copy of a row, right behind the edit of its first."""
    if not extras.any():
        return audit.decode()
    out, row = [], 0
    for letter in audit.decode():
        out.append(letter)
        if letter != "I":
            out.append("D" * int(extras[row]))
            row += 1
    return "".join(out)


# From rows to pieces

_STATS = ("cost", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "least_turn", "most_turn", "first_turn", "last_turn")
_LEGAL = {(1, 2), (2, 3), (3, 2)}


def _stats(codes: np.ndarray, extras: np.ndarray, turns: np.ndarray) -> list[int | None]:
    initial, blank, duplicate = codes & 3, (codes & 4) > 0, (codes & 8) > 0
    again = int(extras.sum())
    pairs = initial[:-1] * 4 + initial[1:]
    legal = np.isin(pairs, [a * 4 + b for a, b in _LEGAL]).sum() if len(pairs) else 0
    known = turns[turns != _FIRST]
    blanks = int((1 + extras)[blank].sum())
    duplicates = int((1 + extras)[~blank & duplicate].sum() + extras[~blank & ~duplicate].sum())
    return [
        DELETE * again, blanks, duplicates, int(((codes & 16) > 0).sum()), len(pairs) - int(legal) + again, int(initial[0]), int(initial[-1]),
        len(np.unique(known)), int(known.min()) if len(known) else None, int(known.max()) if len(known) else None, int(turns[0]), int(turns[-1]),
    ]


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``most`` rows, from rows that come in order. Conversations that lie inside the partition and in one piece are solved at once."""
    schema = pa.schema([("conv", pa.string()), ("t", pa.int64()), ("role", pa.string()), ("h1", pa.int64()), ("h2", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("codes", pa.binary()), ("extras", pa.binary()), ("matrix", pa.list_(pa.int64())), ("audit", pa.string()), ("stats", pa.list_(pa.int64()))])
    part, block = files.partition(), 0
    open_conv, kept, held, alone = None, [], 0, False
    done: list[dict] = []

    def close(inside: bool) -> None:
        nonlocal kept, held, block
        if not held:
            return
        codes, extras, turns = (np.concatenate([x[k] for x in kept]) for k in (0, 1, 2))
        done.append(dict(zip(KEY, kept[0][3])) | {"part": part, "block": block, "whole": inside, "codes": codes, "extras": extras, "stats": _stats(codes, extras, turns)})
        block += 1
        kept, held = [], 0

    def solved() -> pa.RecordBatch:
        whole = [p for p in done if p["whole"]]
        for piece, cost, audit in zip(whole, *solve([p["codes"] for p in whole])):
            piece["audit"] = _with_extras(audit, piece["extras"])
            piece["stats"][0] += cost
        for piece in done:
            if not piece["whole"]:
                piece["matrix"] = matrix(piece["codes"]).reshape(-1).tolist()
            piece |= {"codes": None if piece["whole"] else piece["codes"].astype(np.uint8).tobytes(), "extras": None if piece["whole"] else piece["extras"].astype("<i8").tobytes()}
        out = pa.RecordBatch.from_pylist(done, schema=schema)
        done.clear()
        return out

    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column("conv"))
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("code", "extra", "t")]
        start = 0
        for conv, stop in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if conv != open_conv:
                close(alone)
                open_conv, alone, first = conv, not first, False
            while start < stop:
                upto = min(stop, start + most - held)
                key = [batch.column(c)[start].as_py() for c in KEY] if not held else None
                kept.append((columns[0][start:upto].astype(np.int64), columns[1][start:upto], columns[2][start:upto], key))
                held += upto - start
                start = upto
                if held == most:
                    alone = False
                    close(False)
        if sum(len(p["codes"]) for p in done) >= _BATCH // 4:
            yield solved()
    close(False)
    if done:
        yield solved()


# Chaining the pieces of conversations that have more than one


def _by_conv(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one conversation at a time, from rows sorted by it."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["conv"] != rows[0]["conv"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("after", pa.list_(pa.int64())), ("closed", pa.bool_()), ("begins", pa.int64())])
    for rows in _by_conv(batches):
        after, out = _inserted(_ACCEPT[None])[0], []
        for row in reversed(rows):
            closed = row is rows[-1]
            out.append({"part": row["part"], "block": row["block"], "after": (_ACCEPT if closed else after).tolist(), "closed": closed, "begins": None})
            after = (np.array(row["matrix"]).reshape(4, 4) + after).min(axis=1)
        out[-1]["begins"] = int(after[0])
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each state before a piece: its audit and the state after it."""
    schema = pa.schema([("conv", pa.string()), ("part", pa.int64()), ("block", pa.int64()), ("begins", pa.int64()), ("audits", pa.list_(pa.string())), ("states", pa.list_(pa.int64()))])
    for batch in batches:
        for row in batch.to_pylist():
            codes = np.frombuffer(row["codes"], dtype=np.uint8).astype(np.int64)[None]
            end, closed = np.array([row["after"]]), np.array([row["closed"]])
            cost = _costs(codes, end, closed)
            audits, nodes = _ways(codes, cost, end, closed, np.arange(4))
            extras = np.frombuffer(row["extras"], dtype="<i8")
            yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("conv", "part", "block", "begins")} | {"audits": [_with_extras(a, extras) for a in audits], "states": (nodes % 4).tolist()}], schema=schema)


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("audit", pa.string()), ("begins", pa.int64())])
    for rows in _by_conv(batches):
        state, out = 0, []
        for row in rows:
            out.append({"part": row["part"], "block": row["block"], "audit": row["audits"][state], "begins": row["begins"]})
            state = row["states"][state]
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _chained(pieces: DataFrame) -> DataFrame:
    """``(part, block, audit, begins)`` of the pieces that aren't solved yet; ``begins`` is the cost of a conversation, at its first piece."""
    left = pieces.filter("not whole")
    ordered = left.select("conv", "part", "block", "matrix").repartition("conv").sortWithinPartitions("conv", "part", "block")
    after = ordered.mapInArrow(_backwards, "part long, block long, after array<long>, closed boolean, begins long")
    joined = left.select("conv", "part", "block", "codes", "extras").join(after, ["part", "block"])
    variants = joined.mapInArrow(_variants, "conv string, part long, block long, begins long, audits array<string>, states array<long>")
    return variants.repartition("conv").sortWithinPartitions("conv", "part", "block").mapInArrow(_forwards, "part long, block long, audit string, begins long")


# Replaying the audits over the texts

_RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROLES = {2: "user", 3: "assistant"}


class _Replay:
    """Applies a conversation's audit to its rows as they come, and adds up the figures of its pieces."""

    def __init__(self, conv: str):
        self.conv, self.state, self.audits, self.at = conv, 0, [], 0
        self.hash, self.empty = hashlib.sha256(), True
        self.sums = [0] * 5
        self.least = self.most = self.last = self.last_turn = None
        self.turns = 0

    def piece(self, audit: str, stats: list[int | None]) -> None:
        self._insert()
        self.audits.append(audit)
        self.at = 0
        row = dict(zip(_STATS, stats))
        self.sums = [a + b for a, b in zip(self.sums, stats)]
        if self.last is not None and (self.last, row["first"]) not in _LEGAL:
            self.sums[4] += 1
        self.turns += row["turns"] - (row["turns"] > 0 and row["first_turn"] != _FIRST and self.last_turn == row["first_turn"])
        for name, pick in (("least", min), ("most", max)):
            known = [x for x in (getattr(self, name), row[f"{name}_turn"]) if x is not None]
            setattr(self, name, pick(known) if known else None)
        self.last, self.last_turn = row["last"], row["last_turn"]

    def _write(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False

    def _insert(self) -> None:
        while self.audits and self.at < len(self.audits[-1]) and self.audits[-1][self.at] == "I":
            self.at += 1
            self.state = int(_NEXT[self.state])
            self._write(_ROLES[self.state], "")

    def row(self, role: str, text: str, times: int) -> None:
        self._insert()
        edit = self.audits[-1][self.at]
        self.at += times
        if edit == "D":
            return
        self.state = int(_NEXT[self.state]) if edit == "R" else {"s": 1, "u": 2, "a": 3}[role[0]]
        self._write(_ROLES[self.state] if edit == "R" else role, text)

    def result(self) -> dict:
        self._insert()
        cost, blank, duplicate, truncated, illegal = self.sums
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return dict(conv=self.conv, gaps=gaps, blank=blank, duplicate=duplicate, truncated=truncated, illegal=illegal, cost=cost, audit="".join(self.audits), repaired_sha256=self.hash.hexdigest())


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string() if n in ("conv", "audit", "repaired_sha256") else pa.int64()) for n in (f.split()[0] for f in _RESULT.split(", "))])
    current, out = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "role", "text", "times", "audit", "stats")]
        for conv, role, text, times, audit, stats in zip(*columns):
            if current is None or conv != current.conv:
                if current:
                    out.append(current.result())
                current = _Replay(conv)
            if stats is not None:
                current.piece(audit, stats)
            else:
                current.row(role, text, times)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if current:
        out.append(current.result())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Results per conversation of rows ``(conv_id, turn, role, text, times)``; rows with 0 ``times`` only name their conversation."""
    named = rows.withColumns({"conv": _space("conv_id"), "t": F.coalesce("turn", F.lit(_FIRST)), "role": _space("role"), "text": _space("text")})
    conversations = named.groupBy("conv").agg(F.min("conv_id").alias("conv_id"))
    hashes = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")}
    counted = named.filter("times > 0").withColumns(hashes).groupBy(*KEY).agg(F.sum("times").alias("times"), F.first("text").alias("text"))
    blank = r"[^\x20\x09-\x0D]"
    faults = {"blank": ~F.col("text").rlike(blank), "cut": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")}
    table = materialize(counted.withColumns(faults), "damaged-rows")
    firsts = table.groupBy("conv", "role", "h1", "h2").agg(F.min("t").alias("first_t"))
    seen = table.select(*KEY, "times", "blank", "cut").join(firsts, ["conv", "role", "h1", "h2"])
    initial = F.substring("role", 1, 1)
    fault = F.when(F.col("blank"), 4).when(F.col("t") > F.col("first_t"), 8).when(F.col("cut"), 16).otherwise(0)
    code = fault + F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    compact = seen.select(*KEY, code.alias("code"), (F.col("times") - 1).alias("extra"))
    pieces = materialize(compact.repartitionByRange(*KEY).sortWithinPartitions(*KEY).mapInArrow(lambda batches: _cut(batches, block), PIECES), "pieces")
    chained = _chained(pieces).withColumnRenamed("audit", "chained")
    total = F.coalesce(F.element_at("stats", 1), F.lit(0)) + F.coalesce("begins", F.lit(0))
    figures = F.concat(F.array(total), F.slice("stats", 2, len(_STATS) - 1)).alias("stats")
    audits = pieces.join(chained, ["part", "block"], "left").select(*KEY, F.coalesce("audit", "chained").alias("audit"), figures, F.lit(0).alias("kind"))
    texts = table.select(*KEY, "times", "text", F.lit(1).alias("kind"))
    both = texts.unionByName(audits, allowMissingColumns=True)
    results = both.repartition("conv").sortWithinPartitions(*KEY, "kind").mapInArrow(_replayed, _RESULT)
    joined = conversations.join(results, "conv", "left")
    names = [n for n in (f.split()[0] for f in _RESULT.split(", ")) if n != "conv"]
    missing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return joined.select("conv_id", *[F.coalesce(n, missing.get(n, F.lit(0).cast("long"))).alias(n) for n in names])
