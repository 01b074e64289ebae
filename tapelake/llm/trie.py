"""A trie of conversations by turns: which openings are shared, by whom, and how many words a prefix cache saves.

A sequence of turns is known by hashes of all its prefixes: the exclusive or of a hash of each turn at its place, 128 bits,
which is a running value that can be cut anywhere. The compacted trie has a node for every place where sequences part or end;
a node's name is the depth and hash of its extent. As in a z-fast trie, a node is found under its handle, the prefix whose
length is the two-fattest number of its edge, the multiple of the highest power of two. Sequences are inserted in batches.
In a batch each waiting sequence finds the node at which it leaves the trie by fat binary search: probing the two-fattest
length of the interval left halves it, hit or miss. It is compared with that node's edge, splits the edge where it leaves,
and of those that leave at one place by the same turn one, taken by hash, becomes a leaf; the others wait for the next
batch, in which they part further down. Taken at random, a leaf halves what is below, so batches grow with the logarithm of
the number of sequences even where branches nest deeply. Finally edges are expanded to a row for each depth.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import settle
from tapelake.operators.running import Running, with_running

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation that are summed at once, and ids that are joined at once.
CHUNK, IDS = 1024, 4096
NAME = ["depth", "x", "y"]
EMPTY = sha256(b"").hexdigest()


def two_fattest(low: Column, high: Column) -> Column:
    """The number of ``(low, high]`` that the highest power of two divides."""
    x = low.bitwiseXOR(high)
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseOR(F.shiftrightunsigned(x, k))
    return high.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(x, 1)))


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, t1, t2, words`` of ``turns(conv_id, turn, role, text)``: turns counted from 1, hashed."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(text, role, F.lit(1)).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62)))
    order = [F.col("turn").asc_nulls_first(), "t1", "t2"]
    return with_running(rows, ["conv_id"], chunk, order, {"depth": Running("count", F.lit(1))}).drop("turn")


def rebuilt(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open as others do: ``(steps, convs)``. With h the CRC-32 of the decimal conv_id c modulo 4, c takes
    the first h turns of conversation ``c - c % 20`` (those there are) and then its own after its first h."""
    steps = settle(steps, "turns")
    lengths = steps.groupBy("conv_id").agg(F.max("depth").alias("n"))
    own = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))
    base = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = lengths.select("conv_id", own.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    convs = convs.join(base, "base", "left").withColumn("took", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = settle(convs.select("conv_id", "h", "base", "took"), "opened")
    kept = steps.join(convs, "conv_id").filter("depth > h").withColumn("depth", F.col("depth") - F.col("h") + F.col("took"))
    first = steps.filter("depth <= 3").withColumnRenamed("conv_id", "base")
    taken = convs.join(first, "base").filter("depth <= took")
    columns = ["conv_id", "depth", "t1", "t2", "words"]
    return kept.select(columns).unionByName(taken.select(columns)), convs.select("conv_id")


def _prefixes(steps: DataFrame) -> DataFrame:
    """``conv_id, depth, x, y, words, upto``: the hash of each prefix, its last turn's words and all its words."""
    hashed = steps.select(
        "conv_id", "depth", F.xxhash64("depth", "t1", "t2").alias("x"), F.xxhash64("t2", "depth", "t1").alias("y"), "words",
        F.floor(F.col("depth") / CHUNK).alias("chunk"),
    )
    whole = hashed.groupBy("conv_id", "chunk").agg(F.bit_xor("x").alias("cx"), F.bit_xor("y").alias("cy"), F.sum("words").alias("cw"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(
        "conv_id", "chunk", *(F.coalesce(f(c).over(before), F.lit(0)).alias(c) for f, c in ((F.bit_xor, "cx"), (F.bit_xor, "cy"), (F.sum, "cw")))
    )
    here = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hashed.join(whole, ["conv_id", "chunk"]).select(
        "conv_id", "depth", "words",
        F.bit_xor("x").over(here).bitwiseXOR(F.col("cx")).alias("x"),
        F.bit_xor("y").over(here).bitwiseXOR(F.col("cy")).alias("y"),
        (F.sum("words").over(here) + F.col("cw")).alias("upto"),
    )


def _exits(waiting: DataFrame, nodes: DataFrame, paths: DataFrame, own: DataFrame, longest: int) -> DataFrame:
    """For each waiting sequence the node whose edge it leaves, the depth at which it does, its prefixes there and a turn on.

    The node is the last that fat binary search finds, or that node's child by the sequence's next turn. Prefixes meet the
    trie's handles, and the first prefixes of its edges, in one join; a sequence then probes what it met.
    """
    way = paths.select(F.col("s").alias("rep"), F.col("depth").alias("f"), F.col("x").alias("hx"), F.col("y").alias("hy"))
    steps = nodes.filter("depth > 0").join(way, "rep")
    handle, door = F.col("f") == two_fattest(F.col("up"), F.col("depth")), F.col("f") == F.col("up") + 1
    keys = steps.filter(handle | door).select(
        "f", "hx", "hy", F.struct("depth", "x", "y", "rep").alias("node"), handle.alias("handle"), door.alias("door")
    )
    met = own.select("s", F.col("depth").alias("f"), F.col("x").alias("hx"), F.col("y").alias("hy")).join(keys, ["f", "hx", "hy"])
    entry = F.struct("f", "node")
    met = met.groupBy("s").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("handle"), entry))).alias("handles"),
        F.map_from_entries(F.collect_list(F.when(F.col("door"), entry))).alias("doors"),
    )

    def probe(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        f = two_fattest(low, high)
        node = F.try_element_at("handles", f)
        hit = node.isNotNull()
        halved = F.struct(
            F.when(hit, F.least(node["depth"], high)).otherwise(low).alias("low"),
            F.when(hit, high).otherwise(f - 1).alias("high"),
            F.coalesce(node, state["node"]).alias("node"),
        )
        return F.when(low < high, halved).otherwise(state)

    nothing = F.lit(None).cast("long")
    root = F.struct(*(F.lit(0).cast("long").alias(c) for c in NAME), nothing.alias("rep"))
    start = F.struct(F.lit(0).cast("long").alias("low"), F.col("length").alias("high"), root.alias("node"))
    rounds = F.sequence(F.lit(1), F.lit(longest.bit_length()))
    last = F.aggregate(rounds, start, probe)["node"]
    state = waiting.join(met, "s", "left").withColumn("last", last)
    state = state.withColumn("exit", F.coalesce(F.try_element_at("doors", F.col("last.depth") + 1), F.col("last")))
    names = ["s", "length", "lx", "ly", "e_depth", "e_x", "e_y"]
    exits = [F.col(f"exit.{c}").alias(f"e_{c}") for c in NAME]
    found = state.select("s", "length", "lx", "ly", *exits, F.col("exit.rep").alias("rep")).join(own, "s")
    # A sequence follows the edge as far as its prefixes are those of the one that passes the node.
    edge = paths.select(F.col("s").alias("rep"), *NAME, F.lit(True).alias("same"))
    found = found.join(edge, ["rep", *NAME], "left")
    same, here = F.col("same") & (F.col("depth") <= F.col("e_depth")), F.struct("x", "y")
    same = F.coalesce(same, F.lit(False))
    left = found.groupBy(*names).agg(
        F.max(F.when(same, F.struct(*NAME))).alias("until"), F.min(F.when(~same, F.struct(*NAME))).alias("after")
    )
    zero = F.lit(0).cast("long")
    places = [F.coalesce(f"until.{c}", zero).alias(n) for c, n in zip(NAME, ("far", "fx", "fy"))]
    return left.select(*names, *places, F.col("after.x").alias("nx"), F.col("after.y").alias("ny"))


def _inserted(nodes: DataFrame, left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with a batch's splits and leaves, and the sequences that still wait."""
    by_hash = F.struct(F.xxhash64("s"), "s")
    exits = [F.col(f"e_{c}") for c in NAME]
    cuts = left.filter("far > 0 and far < e_depth").groupBy(*exits, "far", "fx", "fy").agg(F.min_by("s", by_hash).alias("rep"))
    cuts = cuts.select(
        *exits, F.col("far").alias("depth"), F.col("fx").alias("x"), F.col("fy").alias("y"), F.lit(None).cast("long").alias("up"), "rep"
    )
    chain = nodes.select(*[F.col(c).alias(f"e_{c}") for c in NAME], *NAME, "up", "rep").unionByName(cuts)
    edge = Window.partitionBy(*exits)
    up = F.coalesce(F.lag("depth").over(edge.orderBy("depth")), F.max("up").over(edge))
    parted = chain.select(*NAME, up.alias("up"), "rep")
    gone = left.filter("far < length")
    first = gone.groupBy("far", "fx", "fy", "nx", "ny").agg(F.min_by(F.struct("s", "length", "lx", "ly"), by_hash).alias("first"))
    leaves = first.select(
        F.col("first.length").alias("depth"), F.col("first.lx").alias("x"), F.col("first.ly").alias("y"), F.col("far").alias("up"),
        F.col("first.s").alias("rep"),
    )
    waiting = gone.join(first.select("first.s"), "s", "left_anti").select("s", "length", "lx", "ly")
    return settle(parted.unionByName(leaves), "nodes"), settle(waiting, "waiting")


def compacted(paths: DataFrame, strings: DataFrame) -> DataFrame:
    """``depth, x, y, up, rep`` for each node of the compacted trie: its name, the depth of its parent, and a sequence
    through it; no sequence stands for more than two nodes."""
    root = strings.agg(F.min("s").alias("rep")).filter("rep is not null")
    nodes = root.select(*(F.lit(0).cast("long").alias(c) for c in NAME), F.lit(-1).cast("long").alias("up"), "rep")
    waiting = strings.filter("length > 0").select("s", "length", "lx", "ly")
    while True:
        count, longest = waiting.agg(F.count("*"), F.max("length")).first()
        if not count:
            return nodes
        own = settle(paths.filter("depth > 0").join(waiting.select("s"), "s", "left_semi").select("s", *NAME), "own")
        left = settle(_exits(waiting, nodes, paths, own, longest), "left")
        nodes, waiting = _inserted(nodes, left)


def _ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node. Ids come in blocks by value, so one node's are a sorted stream."""
    block = F.floor(F.col("conv_id") / IDS)
    some = ends.groupBy(*NAME, block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    some = some.select(*NAME, "block", F.concat_ws(",", F.transform("ids", lambda c: c.cast("string"))).alias("ids"))
    some = some.repartition(*NAME).sortWithinPartitions(*NAME, "block").select(*NAME, "ids")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, running = None, None
        for batch in batches:
            out = []
            for *now, ids in zip(*(batch[c].tolist() for c in [*NAME, "ids"])):
                if now != name:
                    if name is not None:
                        out.append((*name, running.hexdigest()))
                    name, running = now, sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*NAME, "ends_sha256"])
        if name is not None:
            yield pd.DataFrame([(*name, running.hexdigest())], columns=[*NAME, "ends_sha256"])

    return some.mapInPandas(digest, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(steps: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """A row for each different opening, from the root, which is empty, on: ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``steps`` are as ``numbered`` gives them; ``convs(conv_id)`` adds conversations without turns. saved_tokens sums, over the
    node and all below, the words of the last turn times the members but one. Null role and text are empty; turns of
    one number come in the order of a hash of role and text, repeated ones both; rows without a conv_id belong to no
    conversation; without conversations there are no rows, not even a root; further columns are ignored. A long
    conversation is hashed in parts, and a text is read whole, once.
    """
    marks = settle(_prefixes(steps), "prefixes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "x", "y")]
    name = F.struct(*NAME)
    ends = marks.groupBy("conv_id").agg(F.max(name).alias("end")).select("conv_id", "end.*")
    if convs is not None:
        ends = ends.unionByName(convs.join(ends, "conv_id", "left_anti").select("conv_id", *zero))
    ends = settle(ends, "conversations")
    strings = settle(ends.groupBy(*NAME).agg(F.min("conv_id").alias("s"), F.count("*").alias("n")), "sequences")
    strings = strings.select("s", "n", F.col("depth").alias("length"), F.col("x").alias("lx"), F.col("y").alias("ly"))
    paths = marks.withColumnRenamed("conv_id", "s").join(strings.select("s", "n"), "s")
    no_words = [F.lit(0).cast("long").alias(c) for c in ("words", "upto")]
    columns = ["s", "n", *NAME, "words", "upto"]
    paths = settle(paths.select(columns).unionByName(strings.select("s", "n", *zero, *no_words)), "paths")
    nodes = compacted(paths, strings)

    members = paths.groupBy(*NAME).agg(F.sum("n").alias("n_convs"), F.min("s").alias("conv_id"))
    nodes = settle(nodes.join(members, NAME), "counted")
    # Each edge with its parent's row: one depth a row, from the parent's down.
    of = ["up", "rep", "n_convs", "conv_id"]
    edge = nodes.select(F.struct(*NAME).alias("node"), *of)
    way = paths.select(F.col("s").alias("rep"), *NAME, "words", "upto")
    span = settle(edge.join(way, "rep").filter("depth >= up and depth <= node.depth"), "edges")
    above = span.filter("depth = up").select("node", F.struct(*NAME).alias("parent"), F.col("upto").alias("parent_upto"))
    last = span.filter("depth = node.depth").select("node", "rep", "n_convs", "upto").join(above, "node", "left")
    children = above.groupBy("parent").agg(F.count("*").alias("n_children"))
    last = last.join(children.withColumnRenamed("parent", "node"), "node", "left")
    saved = (F.col("n_convs") - 1) * (F.col("upto") - F.coalesce("parent_upto", F.lit(0)))
    last = last.select("node", "parent", F.coalesce("parent_upto", F.lit(0)).alias("parent_upto"), "rep", F.coalesce("n_children", F.lit(0)).alias("n_children"), saved.alias("saved"))
    last = settle(last.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "weights")
    # Every node counts for all openings of its sequence; only a node's name is looked up afterwards.
    gain = last.filter("leaf > 0 or saved > 0").select("rep", F.col("node.depth").alias("end"), "leaf", "saved")
    sums = gain.join(way, "rep").filter("depth <= end").groupBy(name.alias("node")).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("below"))
    told = last.join(sums, "node").select("node", "parent", "parent_upto", F.col("n_children").alias("fan"), "n_leaves", "below")
    first = nodes.select(F.struct(*NAME).alias("parent"), F.col("conv_id").alias("top"))
    told = told.join(first, "parent", "left")
    digests = _ends_digest(ends).select(F.struct(*NAME).alias("node"), "ends_sha256")
    told = told.join(digests, "node", "left")
    rows = span.filter("depth > up").join(told, "node")
    end = F.col("depth") == F.col("node.depth")
    return rows.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") - 1 > F.col("up"), F.col("conv_id")).otherwise(F.col("top")).alias("parent_conv_id"),
        "n_convs",
        F.when(end, F.col("fan")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("words") - F.col("parent_upto"))).alias("saved_tokens"),
        F.when(end, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"),
    )


def opened_trie(turns: DataFrame) -> DataFrame:
    """``prefix_trie`` of the conversations of ``turns(conv_id, turn, role, text)`` as ``rebuilt`` makes them."""
    return prefix_trie(*rebuilt(numbered(turns)))


#: The same rows in SQL. CRC-32 is its polynomial division, bit by bit; an opening is the list of its turns.
SQL = """
with own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos,
         struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) as said
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 20 as base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
             lambda s, c: list_reduce([xor(s, c), 0, 0, 0, 0, 0, 0, 0, 0],
                                   lambda v, z: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)), 4294967295) % 4 as h
  from (select distinct conv_id from own)),
built as (
  select c.conv_id, coalesce(list(o.said order by o.conv_id <> c.base or o.pos > c.h, o.pos) filter (o.pos is not null), []) as turns
  from convs c left join own o
    on (o.conv_id = c.base and o.pos <= c.h) or (o.conv_id = c.conv_id and o.pos > c.h)
  group by 1),
steps as (select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from built),
nodes as (
  select depth, turns[1:depth] as opening, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(conv_id, ',' order by conv_id) filter (len(turns) = depth), '') as ends
  from steps group by 1, 2),
weighed as (
  select n.*, p.conv_id as parent_conv_id, coalesce(k.n, 0) as n_children,
         case when n.depth = 0 then 0
              else (n.n_convs - 1) * len(regexp_extract_all(n.opening[n.depth].t, '[^\\x20\\x09-\\x0D]+')) end as gain
  from nodes n
  left join nodes p on p.depth = n.depth - 1 and p.opening = n.opening[1:n.depth - 1]
  left join (select depth - 1 as depth, opening[1:depth - 1] as opening, count(*) as n from nodes where depth > 0 group by 1, 2) k
    on k.depth = n.depth and k.opening = n.opening),
paths as (select opening, n_children, gain, unnest(range(0, depth + 1)) as upto from weighed),
sums as (
  select upto as depth, opening[1:upto] as top, sum((n_children = 0)::int) as n_leaves, sum(gain) as saved
  from paths group by 1, 2)
select w.conv_id, w.depth::bigint as depth, w.parent_conv_id, w.n_convs, w.n_children::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, sha256(w.ends) as ends_sha256
from weighed w join sums s on s.depth = w.depth and s.top = w.opening
"""

cloudpickle.register_pickle_by_value(sys.modules[__name__])
