"""Conversation prefix trie: adaptive radix trees over fixed-width big-endian turn ids, one for each range of the sorted conversations.

1. A turn's id is the first 16 bytes of the SHA-256 of its role and text; a conversation's key is its ids one after another, so texts
   never move. Keys are dealt by range, equal ones by conv_id too, so no prefix or conversation weighs on one task.
2. Each task puts its range into an adaptive radix tree (nodes of 4, 16, 48 and 256 places, compressed paths) and reads the prefixes
   off it at turn-aligned depths. Only prefixes of a range's first and last key can go on in other ranges.
3. Those open prefixes, two a turn and task, are put into trees again, FAN ranges at a time, until all is closed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerframe.llm.common import WORD, cut, table

#: Bytes of a turn id.
WIDTH = 16
#: Turns of a range's conversations, about; ranges whose open prefixes meet in one tree.
TURNS, FAN = 100_000, 16
#: Bytes of ids that a piece of an ends list holds.
PIECE = 1 << 20
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_KIND = (
    "conv_id long, depth int, parent_conv_id long, parent_ref binary, ref binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary,"
    " part long, key binary, words array<int>, n_end long, min_end long, low boolean, high boolean, piece int, data binary"
)
_COLUMNS = [c.split()[0] for c in _KIND.split(", ")]


class Few:
    """A layout of up to 4 or 16 places: sorted bytes beside their nodes."""

    def __init__(self, most: int, keys: bytes = b"", nodes: tuple = ()) -> None:
        self.most, self.keys, self.nodes = most, bytearray(keys), list(nodes)

    def find(self, b: int):
        at = self.keys.find(b)
        return self.nodes[at] if at >= 0 else None

    def put(self, b: int, node):
        """The layout that holds node under b: this one, or a larger one."""
        at = self.keys.find(b)
        if at >= 0:
            self.nodes[at] = node
            return self
        if len(self.keys) == self.most:
            larger = Few(16, bytes(self.keys), self.nodes) if self.most == 4 else Indexed(self.keys, self.nodes)
            return larger.put(b, node)
        at = sum(k < b for k in self.keys)
        self.keys.insert(at, b)
        self.nodes.insert(at, node)
        return self

    def all(self) -> list:
        return self.nodes


class Indexed:
    """A layout of up to 48 places: an index of 256 bytes into a list of nodes."""

    def __init__(self, keys: bytes, nodes: list) -> None:
        self.index, self.nodes = bytearray(256), list(nodes)
        for at, b in enumerate(keys):
            self.index[b] = at + 1

    def find(self, b: int):
        at = self.index[b]
        return self.nodes[at - 1] if at else None

    def put(self, b: int, node):
        if at := self.index[b]:
            self.nodes[at - 1] = node
            return self
        if len(self.nodes) == 48:
            return Full(self.index, self.nodes).put(b, node)
        self.nodes.append(node)
        self.index[b] = len(self.nodes)
        return self

    def all(self) -> list:
        return [self.nodes[at - 1] for at in self.index if at]


class Full:
    """A layout of 256 places."""

    def __init__(self, index: bytearray, nodes: list) -> None:
        self.nodes = [nodes[at - 1] if at else None for at in index]

    def find(self, b: int):
        return self.nodes[b]

    def put(self, b: int, node):
        self.nodes[b] = node
        return self

    def all(self) -> list:
        return [x for x in self.nodes if x is not None]


class Node:
    """A place where paths end or part; the bytes from its parent's depth to its own are the compressed path, read off `key`."""

    __slots__ = ("key", "depth", "words", "own", "layout", "sums")

    def __init__(self, key: bytes, depth: int, words, own) -> None:
        self.key, self.depth, self.words, self.own, self.layout, self.sums = key, depth, words, own, None, None

    def put(self, node: "Node") -> None:
        self.layout = (self.layout or Few(4)).put(node.key[self.depth], node)


class Own:
    """What ends at a prefix, or was closed below it in other trees: conversations, and sums over closed prefixes."""

    __slots__ = ("n_end", "min_end", "convs", "least", "children", "leaves", "saved", "low", "high", "ids")

    def __init__(self, n_end=0, min_end=None, convs=0, least=None, children=0, leaves=0, saved=0, low=False, high=False, ids=()) -> None:
        self.n_end, self.min_end, self.convs, self.least, self.children = n_end, min_end, convs, least, children
        self.leaves, self.saved, self.low, self.high, self.ids = leaves, saved, low, high, list(ids)

    def add(self, other: "Own") -> None:
        self.n_end, self.convs, self.children = self.n_end + other.n_end, self.convs + other.convs, self.children + other.children
        self.leaves, self.saved, self.low, self.high = self.leaves + other.leaves, self.saved + other.saved, self.low or other.low, self.high or other.high
        self.min_end, self.least = _least(self.min_end, other.min_end), _least(self.least, other.least)
        self.ids += other.ids


def _least(*values):
    return min((x for x in values if x is not None), default=None)


def insert(root: Node, key: bytes, words, own: Own) -> None:
    """Puts a key into the tree: down the nodes, and where its bytes leave a compressed path, the path is split."""
    node = root
    while True:
        at = node.depth
        if len(key) == at:
            if node.own:
                node.own.add(own)
            else:
                node.own, node.words = own, words
            return
        child = node.layout.find(key[at]) if node.layout else None
        if child is None:
            node.put(Node(key, len(key), words, own))
            return
        end = min(child.depth, len(key))
        a, b = key[at:end], child.key[at:end]
        same = end if a == b else end - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8
        if same < child.depth:
            part = Node(child.key, same, child.words, None)
            part.put(child)
            node.put(part)
            child = part
        node = child


class Rows:
    """Columns of the rows that a tree gives."""

    def __init__(self) -> None:
        self.columns: dict[str, list] = {c: [] for c in _COLUMNS}

    def add(self, **values) -> int:
        for c, column in self.columns.items():
            column.append(values.get(c))
        return len(self.columns["depth"]) - 1

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n = len(self.columns["depth"])
        for at in range(0, n, 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(self.columns[f.name][at : at + 10_000], f.type) for f in schema], schema=schema)


def _ref(prefix: bytes) -> bytes:
    return hashlib.blake2b(prefix, digest_size=16).digest()


def read_off(root: Node, part: int, edges, again: bool) -> Rows:
    """The rows of every turn-aligned prefix in the tree, children before parents.

    edges(node, depth) gives (low, high): whether the prefix may go on in an earlier or later range; such prefixes give open rows,
    with sums over what is closed below them. Other rows are whole but for the parent's conv_id where the parent is open: that
    has a reference. again: the prefixes were open before, so others refer to them.
    """
    rows, todo = Rows(), [(root, -WIDTH, False)]
    while todo:
        node, above, ready = todo.pop()
        below = node.layout.all() if node.layout else []
        if not ready:
            todo.append((node, above, True))
            todo += [(x, node.depth, False) for x in below]
            continue
        convs = children = leaves = saved = 0
        least, waiting = None, []
        for x in below:
            c, m, ch, lv, sv, w = x.sums
            convs, least, children, leaves, saved = convs + c, _least(least, m), children + ch, leaves + lv, saved + sv
            waiting = waiting + w if len(waiting) <= 8 else (waiting.extend(w) or waiting)
            x.sums = None
        for depth in range(node.depth - node.depth % WIDTH, above, -WIDTH):
            own = node.own if depth == node.depth and node.own else Own()
            convs, least, children, leaves, saved = convs + own.convs, _least(least, own.least), children + own.children, leaves + own.leaves, saved + own.saved
            low, high = edges(node, depth)
            turn = depth // WIDTH
            if low or high:
                prefix = node.key[:depth]
                ref = _ref(prefix)
                for i in waiting:
                    rows.columns["parent_ref"][i] = ref
                rows.add(depth=turn, ref=ref, part=part, key=prefix, words=list(node.words[:turn]), n_end=own.n_end, min_end=own.min_end, low=low, high=high, n_convs=convs, conv_id=least, n_children=children, n_leaves=leaves, saved_tokens=saved)
                data, n = b"", 0
                for i in own.ids:
                    data += b"%d," % i
                    if len(data) >= PIECE:
                        rows.add(depth=turn, ref=ref, part=part, piece=n, data=data)
                        data, n = b"", n + 1
                if data:
                    rows.add(depth=turn, ref=ref, part=part, piece=n, data=data)
                convs, least, children, leaves, saved, waiting = 0, None, 0, 0, 0, []
                continue
            convs, least = convs + own.n_end, _least(least, own.min_end)
            leaves, saved = leaves if children else 1, saved + ((convs - 1) * node.words[turn - 1] if turn else 0)
            ends = hashlib.sha256(",".join(map(str, own.ids)).encode()).digest() if own.ids else None
            for i in waiting:
                rows.columns["parent_conv_id"][i] = least
            i = rows.add(depth=turn, conv_id=least, ref=_ref(node.key[:depth]) if again else None, n_convs=convs, n_children=children, n_leaves=leaves, saved_tokens=saved, ends=ends)
            children, waiting = 1, [i]
        node.sums = convs, least, children, leaves, saved, waiting
    return rows


def _first_trees(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of the tree of a task's sorted conversations(key, conv_id, words)."""
    root, first, last = Node(b"", 0, [], None), None, b""
    for batch in batches:
        for key, conv, words in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "words")), strict=True):
            first, last = key if first is None else first, key
            insert(root, key, words, Own(1, conv, ids=(conv,)))
    if first is not None:
        edges = lambda node, depth: (node.key[:depth] == first[:depth], node.key[:depth] == last[:depth])
        yield from read_off(root, TaskContext.get().partitionId(), edges, False).batches(schema)


def _later_trees(rows: pa.Table, group: int, final: bool, schema: pa.Schema) -> pa.Table:
    """Rows of the tree of open prefixes of several ranges."""
    root, parts = Node(b"", 0, [], None), rows.column("part").to_pylist()
    low, high = min(parts), max(parts)
    names = ("key", "words", "n_end", "min_end", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "low", "high")
    for part, key, words, n_end, min_end, convs, least, children, leaves, saved, is_low, is_high in zip(parts, *(rows.column(c).to_pylist() for c in names), strict=True):
        insert(root, key, words, Own(n_end, min_end, convs, least, children, leaves, saved, is_low and part == low, is_high and part == high))
    edges = lambda node, depth: (False, False) if final else (node.own.low, node.own.high)
    return pa.Table.from_batches(read_off(root, group, edges, True).batches(schema), schema)


def _later(final: bool, schema: pa.Schema):
    """_later_trees as a function of a group's key and rows."""

    def trees(key: tuple, rows: pa.Table) -> pa.Table:
        return _later_trees(rows, key[0].as_py(), final, schema)

    return trees


def conversation_keys(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, words): each conversation rebuilt, as the ids of its turns in one key and the words of each turn's text.

    Turns go by number, null first, ties by id. The first h turns of conversation c - c % 20 (the remainder has the sign of c), all if fewer and none if absent, come
    before c's own after its first h; h is the CRC-32 of c's decimal digits, modulo 4.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), F.substring(F.sha2(told, 256), 1, 2 * WIDTH).alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("t"))
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    heads = own.where(F.col("conv_id") % 20 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).join(heads, "base", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    head = F.coalesce("head", F.array().cast(own.schema["turns"].dataType))
    rebuilt = F.concat(F.slice(head, F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    seq = both.select("conv_id", rebuilt.alias("seq"))
    return seq.select("conv_id", F.unhex(F.array_join(F.transform("seq", lambda t: t["id"]), "")).alias("key"), F.transform("seq", lambda t: t["words"]).alias("words"))


def prefix_trie(conversations: DataFrame, turns: int = TURNS, fan: int = FAN) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every distinct prefix of rebuilt conversations.

    conv_id is the smallest member. A null role or text is empty; rows without a conv_id are left out; repeated turns each count, in
    the order of their ids; texts of any length are one id. An empty table gives an empty result. The digest of one prefix's ends is
    over a list in order by its nature: a task reads it in pieces of a megabyte, in bounded memory. One conversation's ids and word counts,
    20 bytes a turn, are one row. Columns other than conv_id, turn, role and text are not read.
    """
    keys = cut(conversation_keys(conversations))
    parts = -(-(keys.agg(F.sum(F.size("words") + 1)).first()[0] or 0) // turns) or 1
    kind = StructType.fromDDL(_KIND)
    schema = to_arrow_schema(kind)
    ranged = keys.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = cut(ranged.mapInArrow(lambda it: _first_trees(it, schema), kind))
    pieces, closed = made.where("data IS NOT NULL"), made.where("key IS NULL AND data IS NULL")
    open_ = made.where("key IS NOT NULL")
    top = open_.agg(F.max("part")).first()[0]
    while top is not None:
        top //= fan
        final = top == 0
        made = cut(open_.withColumn("g", F.floor(F.col("part") / fan)).groupBy("g").applyInArrow(_later(final, schema), kind))
        closed, open_ = closed.unionByName(made.where("key IS NULL")), made.where("key IS NOT NULL")
        top = None if final else top

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ref, sha, kept = None, None, b""
        for batch in batches:
            for own, data in zip(batch.column("ref").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if own != ref:
                    if ref is not None:
                        sha.update(kept[:-1])
                        yield pa.RecordBatch.from_pydict({"own": pa.array([ref], pa.binary()), "open_ends": pa.array([sha.digest()], pa.binary())})
                    ref, sha, kept = own, hashlib.sha256(), b""
                sha.update(kept)
                kept = data
        if ref is not None:
            sha.update(kept[:-1])
            yield pa.RecordBatch.from_pydict({"own": pa.array([ref], pa.binary()), "open_ends": pa.array([sha.digest()], pa.binary())})

    ends = pieces.select("ref", "part", "piece", "data").repartition("ref").sortWithinPartitions("ref", "part", "piece").mapInArrow(hashed, "own binary, open_ends binary")
    # Only prefixes that were open once have a reference: about two a turn and range.
    named = closed.where("ref IS NOT NULL").select("ref", "conv_id")
    parent = named.select(F.col("ref").alias("up"), F.col("conv_id").alias("up_conv"))
    fields = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "ref")
    plain = closed.where("parent_ref IS NULL").select(*fields)
    pending = closed.where("parent_ref IS NOT NULL").join(parent, F.col("parent_ref") == F.col("up"))
    whole = plain.unionByName(pending.withColumn("parent_conv_id", F.col("up_conv")).select(*fields))
    were_open = whole.where("ref IS NOT NULL").join(ends, F.col("ref") == F.col("own"), "left").withColumn("ends", F.col("open_ends"))
    out = whole.where("ref IS NULL").select(*fields).unionByName(were_open.select(*fields))
    sha = F.coalesce(F.lower(F.hex("ends")), F.lit(EMPTY_SHA256))
    return out.select("conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", sha.alias("ends_sha256"))


def op11(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of prefix_trie over all conversations; odd rows as there."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: DuckDB, over the table conversations. The CRC-32 of the decimal digits goes bit by bit, a step a row.
OP11_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, conv_id::VARCHAR AS digits, 0 AS step, 4294967295::BIGINT AS x FROM own
  UNION ALL SELECT conv_id, digits, step + 1, xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT
  FROM (SELECT *, CASE WHEN step % 8 = 0 THEN xor(x, ascii(digits[step // 8 + 1])::BIGINT) ELSE x END AS y FROM crc WHERE step < 8 * len(digits))),
h AS (SELECT conv_id, (xor(x, 4294967295) % 4)::BIGINT AS h FROM crc WHERE step = 8 * len(digits)),
seqs AS MATERIALIZED (SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS seq
  FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
nodes AS MATERIALIZED (SELECT d, seq[1:d] AS prefix, min(conv_id) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends
  FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM seqs) GROUP BY d, prefix),
kids AS MATERIALIZED (SELECT p.d, p.prefix, count(c.d) AS n_children FROM nodes p LEFT JOIN nodes c ON c.d = p.d + 1 AND c.prefix[1:p.d] = p.prefix GROUP BY p.d, p.prefix),
cost AS MATERIALIZED (SELECT n.d, n.prefix, n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(n.prefix[n.d].text, '[^\x20\x09-\x0D]+')) END AS saved FROM nodes n JOIN kids USING (d, prefix)),
up AS (SELECT a AS d, prefix[1:a] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(d + 1)) AS a FROM cost) GROUP BY a, prefix[1:a])
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN kids USING (d, prefix) JOIN up USING (d, prefix) LEFT JOIN nodes p ON p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]
"""
