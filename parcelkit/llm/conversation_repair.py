"""Conversation structure repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?``.

Edits on a conversation's rows in order: Keep (0), Rerole to user or assistant (3), Delete (4; required for blank and
duplicate rows), Insert an empty user or assistant row anywhere (3). A truncated row that stays adds 3. Of the
cheapest edit sequences the one with the ASCII-least audit (the initials of its edits) is taken.

*Search.* Depth-first branch-and-bound over nodes (row, state of the role pattern) with an explicit stack. A suffix's
lower bound cuts the remaining rows into runs of up to ``RUN`` rows and repairs each from whatever state is best for
it; a branch ends when its cost and that bound exceed the incumbent (cost, audit), or when its audit is already past
the incumbent's at equal cost. A table per node keeps the least (cost, audit) that reached it: a prefix that is not
less is dominated. (Two audits at one node and cost are never prefixes of each other, so the lesser stays lesser.)
The search ends with an empty stack, which proves the incumbent.

*Distribution.* Rows are numbered in conversation order by a range partitioning, so a conversation of any length lies
in many tasks; every ``BLOCK`` numbers make a block, and a conversation's rows in a block are a segment. A
conversation in one block is solved whole. The segments of a longer one are solved for every pair of entry and exit
state, and neighbouring solutions are joined, ``FAN`` at a time, until one remains: the table of a node, one level up.
Up to here no text is moved, only a digest of it. The repaired rows come from one shuffle of the texts, as a stream.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, written

# --- fixed values: costs of the edits, the pattern's states, white space of a blank text -----------------------------
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)           # nothing yet, after s, after u, after a
SPACE = r"\x20\x09-\x0D"
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

BLOCK = 256         # rows of a block
FAN = 16            # segments joined at a time
RUN = 4             # rows of a run in the lower bound

_FINAL = (START, ASSISTANT)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}   # what a rerole or insert must bring
_ALL = (START, SYSTEM, USER, ASSISTANT)


def _options(code: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, its cost, state after it) of a row. Codes: x must go; s u a o the role's initial, in capitals if truncated."""
    if code == "x":
        return [("D", DELETE, state)]
    cut = TRUNCATED if code.isupper() else 0
    initial, to = code.lower(), _NEXT[state]
    out = [("D", DELETE, state), ("R", REROLE + cut, to)]
    if initial == "s" and state == START:
        out.append(("K", cut, SYSTEM))
    elif initial == ("u" if to == USER else "a"):
        out.append(("K", cut, to))
    return out


@lru_cache(200_000)
def _run_cost(codes: str, state: int | None, final: bool) -> int:
    """Least cost of a short run of rows on its own, from ``state`` or (None) the best one, to any or a final state."""
    cost = {s: 0 if state is None or s == state else None for s in _ALL}

    def inserts(cost):
        for _ in range(2):
            for s in _ALL:
                c, to = cost[s], _NEXT[s]
                if c is not None and (cost[to] is None or c + INSERT < cost[to]):
                    cost[to] = c + INSERT
        return cost
    cost = inserts(cost)
    for code in codes:
        new = dict.fromkeys(_ALL)
        for s in _ALL:
            if cost[s] is not None:
                for _, c, to in _options(code, s):
                    if new[to] is None or cost[s] + c < new[to]:
                        new[to] = cost[s] + c
        cost = inserts(new)
    return min(c for s, c in cost.items() if c is not None and (not final or s in _FINAL))


def suffix_bounds(codes: str, final: bool) -> list[tuple[int, int, int, int]]:
    """Per row number (and the end) and state: a lower bound of what the rows from there on cost."""
    n = len(codes)
    free, out = [0] * (n + 1), [None] * (n + 1)
    kept = ""                                   # the next rows that may stay, nearest first
    at: list[int] = []                          # where they stand
    gone = 0                                    # rows from here on that must go
    for i in range(n, -1, -1):
        if i < n:
            if codes[i] == "x":
                gone += 1
            else:
                kept, at = (codes[i] + kept)[:RUN], ([i] + at)[:RUN]
        best, by_state = 0, [0] * 4
        for w in range(1, len(at) + 1):
            rest = free[at[w - 1] + 1]
            end = final and not codes[at[w - 1] + 1:].strip("x")
            best = max(best, _run_cost(kept[:w], None, end) + rest)
            for s in _ALL:
                by_state[s] = max(by_state[s], _run_cost(kept[:w], s, end) + rest)
        if not at and final:
            by_state = [_run_cost("", s, True) for s in _ALL]
        free[i] = best
        out[i] = tuple(max(best, c) + DELETE * gone for c in by_state)
    return out


@lru_cache(100_000)
def solve(codes: str, entry: int = START, whole: bool = True) -> dict[int, tuple[int, str]]:
    """exit state -> least (cost, audit) of the rows ``codes`` from the state ``entry``.

    ``whole``: only the best of the final states is returned, else every exit state that can be reached.
    """
    n = len(codes)
    bounds = suffix_bounds(codes, whole)
    best: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]     # dominance tables
    exits = _FINAL if whole else _ALL
    none = (1 << 60, "")
    incumbent = {s: none for s in exits}

    def hopeless(cost: int, audit: str, i: int, state: int) -> bool:
        least = cost + bounds[i][state]
        if whole:
            top, text = min(incumbent.values())
            return least > top or (least == top and audit > text[:len(audit)])
        return all(least > c or (least == c and audit > text[:len(audit)]) for c, text in incumbent.values())

    best[0][entry] = (0, "")
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if best[i][state] != (cost, audit) or hopeless(cost, audit, i, state):
            continue
        if i == n and state in incumbent and (cost, audit) < incumbent[state]:
            incumbent[state] = (cost, audit)
        to = _NEXT[state]
        moves = [(i, to, cost + INSERT, audit + "I")]
        if i < n:
            moves += [(i + 1, s, cost + c, audit + e) for e, c, s in _options(codes[i], state)]
        new = []
        for move in moves:
            j, s, c, a = move
            if best[j].get(s, none) > (c, a) and not hopeless(c, a, j, s):
                best[j][s] = (c, a)
                new.append((c + bounds[j][s], a, move))
        new.sort(reverse=True)                  # the most promising is searched first
        stack.extend(move for _, _, move in new)
    found = {s: r for s, r in incumbent.items() if r != none}
    return {s: found[s] for s in [min(found, key=found.get)]} if whole else found


# --- damage (the query's input) --------------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``copies`` after damage by crc32 of ``conv_id:turn`` modulo 20 (a null
    counts as one space): 0 drops the row, 1 empties the text, 2 removes its ``.!?``, 3 repeats it, 4 sets the role user."""
    def some(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn"))) % 20
    rows = rows.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), hit.alias("hit"))
    return rows.where("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"), F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies"))


# --- the operator ----------------------------------------------------------------------------------------------------

_SOLUTIONS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SOLUTIONS_DDL = "solutions array<struct<entry:int,exit:int,cost:bigint,audit:string>>"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])


def _marked(rows: DataFrame) -> DataFrame:
    """The columns in use, and 16 bytes that stand for a row's text."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), copies.cast("long").alias("copies"))
    return rows.withColumn("mark", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))


def _ordered(marked: DataFrame) -> DataFrame:
    """Distinct rows without their texts, numbered (``pos``) in conversation order; ``copies`` of each."""
    narrow = marked.select(
        "conv_id", "turn", "role", "mark", "copies", (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"))
    same = narrow.groupBy("conv_id", "turn", "role", "mark", "blank", "cut").agg(F.sum("copies").alias("copies"))
    keys = ["conv_id", "turn", "role", "mark"]
    order = same.repartitionByRange(*keys).sortWithinPartitions(*keys)          # nulls come first
    return written(order.withColumn("pos", F.monotonically_increasing_id()), "conversation-order")


def _segments(order: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, ``rows`` in order, and the counts of the segment's faults and illegal neighbours."""
    first = order.groupBy("conv_id", "role", "mark").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    order = order.join(first, "pos", "left")
    spare = F.col("copies") - 1                                                 # blank too, or duplicates of the first
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    again = F.col("new").isNull()
    code = F.when(F.col("blank") | again, "x").when(F.col("cut"), F.upper(letter)).otherwise(letter)
    one = F.struct("pos", "turn", "role", "mark", initial.alias("initial"), code.alias("code"), spare.cast("int").alias("spare"))
    segments = order.groupBy("conv_id", F.shiftright("pos", BLOCK.bit_length() - 1).alias("block")).agg(
        F.sort_array(F.collect_list(one)).alias("rows"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(again, F.col("copies")).otherwise(spare)).alias("duplicate"),
        F.count_if(~F.col("blank") & ~again & F.col("cut")).alias("truncated"), F.sum(spare).alias("spares"))
    pairs = F.transform(F.sequence(F.lit(2), F.greatest(F.size("rows"), F.lit(2))), lambda i: F.concat(
        F.get("rows", i - 2)["initial"], F.get("rows", i - 1)["initial"]))      # null in a segment of one row
    bad = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    return segments.withColumn("illegal", bad + F.col("spares")).withColumn("codes", F.array_join(F.transform(
        "rows", lambda r: F.concat(r["code"], F.repeat(F.lit("x"), r["spare"]))), ""))


def _solved(segments: DataFrame) -> DataFrame:
    """Segments with their ``solutions``; ``alone``: the segment is its whole conversation."""
    several = segments.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select(
        F.col("conv_id").alias("c"), F.lit(False).alias("single"))
    flagged = segments.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left").withColumn(
        "alone", F.coalesce("single", F.lit(True))).drop("c", "single", "spares")

    def run(batches):
        for batch in batches:
            out = []
            for codes, alone in zip(batch.column("codes").to_pylist(), batch.column("alone").to_pylist()):
                out.append([{"entry": entry, "exit": end, "cost": cost, "audit": audit}
                            for entry in ((START,) if alone else _ALL)
                            for end, (cost, audit) in solve(codes, entry, alone).items()])
            yield _with_column(batch, "solutions", pa.array(out, _SOLUTIONS))

    return written(on_workers(flagged).mapInArrow(run, f"{_ddl(flagged)}, {_SOLUTIONS_DDL}"), "solved-segments")


def join_solutions(left: list[dict], right: list[dict]) -> list[dict]:
    """Solutions of two neighbouring stretches as those of both: the least (cost, audit) over the states between."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for a in left:
        for b in right:
            if a["exit"] == b["entry"]:
                key, new = (a["entry"], b["exit"]), (a["cost"] + b["cost"], a["audit"] + b["audit"])
                if key not in best or new < best[key]:
                    best[key] = new
    return [{"entry": e, "exit": x, "cost": c, "audit": t} for (e, x), (c, t) in best.items()]


def _joined(solved: DataFrame) -> DataFrame:
    """``conv_id``, ``solutions`` of the conversations of several segments, joined ``FAN`` at a time."""
    parts = solved.where("not alone").select("conv_id", "block", "solutions")
    # segments numbered from 0: the list holds one number a block of the conversation
    ranked = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("block")).alias("all")).select(
        F.col("conv_id").alias("c"), F.posexplode("all").alias("part", "b"))
    parts = written(parts.join(ranked, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv_id", F.col("part").cast("long").alias("part"), "solutions"), "numbered-segments")

    def run(batches):
        for batch in batches:
            out = [reduce(join_solutions, [p["solutions"] for p in row]) for row in batch.column("parts").to_pylist()]
            yield _with_column(batch.select(["conv_id", "part"]), "solutions", pa.array(out, _SOLUTIONS))

    while parts.where("part > 0").limit(1).count():
        near = parts.groupBy("conv_id", F.floor(F.col("part") / FAN).alias("part")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("part").alias("k"), "solutions"))).alias("parts"))
        schema = f"{_ddl(near.select('conv_id', 'part'))}, {_SOLUTIONS_DDL}"
        parts = written(on_workers(near).mapInArrow(run, schema), "joined-segments")
    return parts


def _best(solutions: str) -> Column:
    """The least (cost, audit) from the start to a final state."""
    ends = F.filter(solutions, lambda s: (s["entry"] == START) & s["exit"].isin(*_FINAL))
    return F.array_min(F.transform(ends, lambda s: F.struct(s["cost"].alias("cost"), s["audit"].alias("audit"))))


def split_audit(audit: str, sizes: list[int]) -> list[tuple[str, int]]:
    """The audit cut into stretches of so many rows each, with the state at the beginning of each. Inserted rows go with
    the row before them, the first ones with the first row."""
    out, lo, seen = [], 0, 0
    system = (len(audit) - audit.count("D")) % 2        # rows after the edits: pairs, behind a system row if odd
    for size in sizes:
        hi, rows = lo, 0
        while hi < len(audit) and (rows < size or audit[hi] == "I"):
            rows += audit[hi] != "I"
            hi += 1
        state = START if not seen else SYSTEM if seen == system else USER if (seen - system) % 2 else ASSISTANT
        out.append((audit[lo:hi], state))
        seen += hi - lo - audit.count("D", lo, hi)
        lo = hi
    return out


def edits(audit: str, rows: list[dict], state: int) -> list[dict]:
    """For each row of a segment: the roles inserted before it, its new role (None: deleted), and the roles inserted
    after it (before the next row's only where the segment ends or copies were deleted)."""
    out, at = [], 0
    for row in rows:
        edit = {"before": [], "new_role": None, "after": []}
        for copy in range(1 + row["spare"]):
            while audit[at] == "I":
                state = _NEXT[state]
                edit["after" if copy else "before"].append(ROLE_OF[state])
                at += 1
            if audit[at] == "K":
                state = SYSTEM if row["initial"] == "s" else _NEXT[state]
                edit["new_role"] = row["role"]
            elif audit[at] == "R":
                state = _NEXT[state]
                edit["new_role"] = ROLE_OF[state]
            at += 1
        out.append({**{k: row[k] for k in ("turn", "role", "mark")}, **edit})
    for _ in audit[at:]:
        state = _NEXT[state]
        out[-1]["after"].append(ROLE_OF[state])
    return out


_EDITS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("mark", pa.binary()), ("before", pa.list_(pa.string())),
                             ("new_role", pa.string()), ("after", pa.list_(pa.string()))]))
_EDITS_DDL = ("edits array<struct<turn:bigint,role:string,mark:binary,before:array<string>,new_role:string,"
              "after:array<string>>>")


def _edited(solved: DataFrame, joined: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``mark`` of every distinct row with its edit (see :func:`edits`)."""
    single = solved.where("alone").select("conv_id", "rows", _best("solutions")["audit"].alias("audit"), F.lit(START).alias("state"))
    sizes = solved.where("not alone").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "block", F.length("codes").alias("size")))).alias("blocks"))
    whole = joined.select(F.col("conv_id").alias("c"), _best("solutions")["audit"].alias("audit"))
    whole = sizes.join(whole, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    def cut(batches):
        for batch in batches:
            out = [[{"block": b["block"], "audit": audit, "state": state} for b, (audit, state) in zip(
                blocks, split_audit(audit, [b["size"] for b in blocks]))]
                for audit, blocks in zip(batch.column("audit").to_pylist(), batch.column("blocks").to_pylist())]
            kind = pa.list_(pa.struct([("block", pa.int64()), ("audit", pa.string()), ("state", pa.int32())]))
            yield _with_column(batch.select(["conv_id"]), "pieces", pa.array(out, kind))

    def apply(batches):
        for batch in batches:
            out = [edits(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("audit", "rows", "state")))]
            yield _with_column(batch.select(["conv_id"]), "edits", pa.array(out, _EDITS))

    kind = _ddl(solved.select("conv_id"))
    pieces = on_workers(whole).mapInArrow(cut, f"{kind}, pieces array<struct<block:bigint,audit:string,state:int>>").select(
        F.col("conv_id").alias("c"), F.explode("pieces").alias("p")).select("c", "p.*")
    several = solved.where("not alone").select("conv_id", F.col("block").alias("b"), "rows").join(
        pieces, (F.col("b") == F.col("block")) & F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", "rows", "audit", "state")
    done = single.unionByName(several).mapInArrow(apply, f"{kind}, {_EDITS_DDL}")
    return done.select("conv_id", F.inline("edits"))


class Repair:
    """A repair of conversations: ``report`` (a row per conversation) and ``rows`` (the repaired conversations)."""

    def __init__(self, rows: DataFrame):
        """``rows``: ``conv_id``, ``turn``, ``role``, ``text`` (nulls: one space) and, if given, ``copies`` of each.

        A conversation's rows stand in the order of turn (nulls first), then role, then a digest of the text; a null
        conv_id is a conversation like any other. Blank, empty and very long texts, repeated rows and ties are rows
        like others; other columns are ignored. An empty table gives no conversation.
        """
        self._rows = _marked(rows)
        order = _ordered(self._rows)
        self._solved = _solved(_segments(order))
        self._joined = _joined(self._solved)
        self._turns = order.groupBy("conv_id").agg(F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))

    @property
    def report(self) -> DataFrame:
        """``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``."""
        by_conv = Window.partitionBy("conv_id").orderBy("block")            # a conversation's segments, not its rows
        edge = F.concat(F.lag(F.element_at("rows", -1)["initial"]).over(by_conv), F.get("rows", F.lit(0))["initial"])
        counts = self._solved.withColumn("edge", F.when(~edge.isin("su", "ua", "au"), 1).otherwise(0)).withColumn(
            "best", F.when(F.col("alone"), _best("solutions")))
        names = ["blank", "duplicate", "truncated", "illegal"]
        counts = counts.select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("edge")).alias("illegal"),
                               F.lit(None).cast("long").alias("gaps"), "best.cost", "best.audit")
        joined = self._joined.select("conv_id", _best("solutions").alias("best")).select("conv_id", "best.*")
        every = counts.unionByName(self._turns, allowMissingColumns=True).unionByName(joined, allowMissingColumns=True)
        return every.groupBy("conv_id").agg(F.max("gaps").alias("gaps"), *[F.sum(c).alias(c) for c in names],
                                            F.max("cost").alias("cost"), F.max("audit").alias("audit"))

    @property
    def rows(self) -> DataFrame:
        """``conv_id``, ``seq`` (from 0), ``role``, ``text``: each conversation's rows follow each other in one partition."""
        keys = ["conv_id", "turn", "role", "mark"]
        texts = self._rows.select(*keys, F.lit(1).alias("kind"), "text")
        plan = _edited(self._solved, self._joined).select(*keys, F.lit(0).alias("kind"), "before", "new_role", "after")
        both = plan.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*keys, "kind")
        kind = _ddl(both.select("conv_id"))

        def run(batches):
            conv, seq, edit = object(), 0, None
            for batch in batches:
                at, seqs, roles, texts = [], [], [], []

                def put(role, text):
                    nonlocal seq
                    at.append(i)
                    seqs.append(seq)
                    roles.append(role)
                    texts.append(text)
                    seq += 1
                columns = [batch.column(c) for c in ("conv_id", "kind", "before", "new_role", "after", "text")]
                for i, (c, is_text, before, role, after) in enumerate(zip(*(x.to_pylist() for x in columns[:5]))):
                    if c != conv:
                        conv, seq, edit = c, 0, None
                    if not is_text:
                        for r in before:
                            put(r, "")
                        edit = role
                        if role is None:
                            for r in after:
                                put(r, "")
                        held = after
                    elif edit is not None:                  # the first copy of a row that stays
                        put(edit, columns[5][i].as_py())
                        for r in held:
                            put(r, "")
                        edit = None
                yield pa.RecordBatch.from_arrays(
                    [columns[0].take(pa.array(at, pa.int64())), pa.array(seqs, pa.int64()), pa.array(roles, pa.string()),
                     pa.array(texts, pa.string())], ["conv_id", "seq", "role", "text"])

        return on_workers(both).mapInArrow(run, f"{kind}, seq bigint, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id``, ``repaired_sha256`` of :attr:`Repair.rows`, as a stream: ``role:text``, joined by line breaks."""
    kind = _ddl(repaired.select("conv_id"))

    def run(batches):
        conv, digest = None, None
        for batch in batches:
            ids, out, at = batch.column("conv_id"), [], []
            for i, (c, seq, role, text) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("conv_id", "seq", "role", "text")))):
                if seq == 0:
                    if digest:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield _hash_rows(out, ids.type)
            last = ids.type
        if digest:
            yield _hash_rows([(conv, digest.hexdigest())], last)

    return on_workers(repaired).mapInArrow(run, f"{kind}, repaired_sha256 string")


def _hash_rows(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())],
                                      ["conv_id", "repaired_sha256"])


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's row per original conversation: damage, report and digest of the repaired rows."""
    repair = Repair(damaged(conversations))
    every = repair.report.unionByName(digests(repair.rows), allowMissingColumns=True).unionByName(
        conversations.select("conv_id").distinct(), allowMissingColumns=True)
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
