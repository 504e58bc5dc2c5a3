"""Spelling variants: words one edit apart, found in tries of letter-group counts.

1. Words are counted over all texts; the frequent long ones are the vocabulary.
2. A word's path is its vector of letter-group counts, level by level (each of a-z,
   and ``ACCENTS`` groups of the letters beyond ASCII). Prefixes that hold more than
   a shard's words are counted level by level; a word's shard is its shortest prefix
   that is not so full. (Equal vectors beyond that are cut by hash.)
3. A word is sent to its own shard, and as a query to every shard that a walk with
   a budget of one deficit and then one surplus reaches. One edit that deletes or
   replaces a letter is such a walk; an insertion is the other word's deletion, and
   a replacement starts from the word with more of the earlier group.
4. A shard's words form a trie. Batches of query vectors walk it depth by depth with
   the same budget. At a leaf, the groups lost and gained say which edits can lead to
   its words; hashes of these find them and their letters are compared. Each pair is
   met once and credited to both words.
5. Forms are followed by joining the words with a form to each other, doubling the
   steps; frequencies rise tenfold each step, so that few rounds suffice.

Memory in a task: a shard's words and one batch of queries. The full prefixes are the
only thing that the driver holds: at most ``LEVELS * MAX_SHARDS`` of them, since a
shard grows with the vocabulary beyond ``MAX_SHARDS`` shards. No pair of words that
share only a leaf leaves a task.

Defined cases: null or empty texts have no words; repeated rows count each; a null
id reads as ''; runs of any length are whole words; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragtide.session import ship_package

from .common import ascii_lower, text_or_empty, written
from .wordhash import mix

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH, MIN_COUNT, RATIO, DIVISOR = 7, 2, 10, 31
ACCENTS = 8
LEVELS = 26 + ACCENTS
SHARD_WORDS, MAX_SHARDS, BATCH = 40_000, 10_000, 4096
#: Group of each code point; the path counts are kept modulo 256, in which a
#: difference of one stays a difference of one.
GROUP = np.array([26 + c % ACCENTS if c >= 0xC0 else max(c - 97, 0) for c in range(256)], np.uint8)
LETTERS = [[c for c in [*range(97, 123), *range(0xC0, 0x100)] if GROUP[c] == g] for g in range(LEVELS)]
MIX = np.uint64(0x9E3779B97F4A7C15)


def words(docs: DataFrame) -> DataFrame:
    """(word, n): lower-cased runs, with the corruption of the contract, by frequency."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(ascii_lower(text_or_empty()), F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % DIVISOR == 0, less).otherwise(F.col("run")).alias("word")).groupBy(
        "word").agg(F.count("*").alias("n"))


class Words:
    """Words as flat code points, with their group counts."""

    def __init__(self, values: pa.Array):
        values = values.cast(pa.string())
        self.text = np.frombuffer("".join(values.to_pylist()).encode("latin-1"), np.uint8)
        self.length = pa.compute.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.length) - self.length
        owner = np.repeat(np.arange(len(values)), self.length)
        group = GROUP[self.text]
        self.count = np.bincount(owner * LEVELS + group, minlength=len(values) * LEVELS).reshape(-1, LEVELS)
        self.path = (self.count & 255).astype(np.uint8)
        # places of each word's letters by group, and where each group starts there
        self.place = np.argsort(owner * LEVELS + group, kind="stable")
        self.first = self.start[:, None] + np.cumsum(self.count, axis=1) - self.count

    @cached_property
    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """The sum over a word's letters of letter * power(place), and prefix sums."""
        at = np.arange(len(self.text)) - np.repeat(self.start, self.length)
        prefix = np.zeros(len(self.text) + 1, np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * powers(int(self.length.max(initial=0)))[at], out=prefix[1:])
        return prefix[self.start + self.length] - prefix[self.start], prefix


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) <= n:
        grown = np.full(2 * n + 2, MIX, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


INVERSE = np.uint64(pow(int(MIX), -1, 1 << 64))


def walk(levels: list[np.ndarray], queries: np.ndarray):
    """(query, leaf, lost, gained): leaves of a trie that each query vector reaches
    with at most one deficit (lost: its level, or -1) and then one surplus (gained).
    ``levels`` holds, for each depth, the sorted keys node * 256 + count; a node's
    number is its key's place."""
    n = len(queries)
    query, node = np.arange(n), np.zeros(n, np.int64)
    lost, gained = np.full(n, -1, np.int8), np.full(n, -1, np.int8)
    for depth, keys in enumerate(levels):
        count = queries[query, depth].astype(np.int64)
        fresh = (lost < 0) & (count > 0)
        once = (lost >= 0) & (gained < 0)
        at = np.concatenate([np.arange(len(query)), np.nonzero(fresh)[0], np.nonzero(once)[0]])
        move = np.concatenate([np.zeros(len(query), np.int64), np.full(fresh.sum(), -1), np.full(once.sum(), 1)])
        key = node[at] * 256 + ((count[at] + move) & 255)
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[found] == key
        at, move, found = at[hit], move[hit], found[hit]
        query, node = query[at], found
        lost = np.where(move < 0, depth, lost[at]).astype(np.int8)
        gained = np.where(move > 0, depth, gained[at]).astype(np.int8)
    return query, node, lost, gained


def trie(paths: np.ndarray) -> list[np.ndarray]:
    """Levels of a trie over distinct, sorted vectors; a leaf is a vector's number."""
    parent, levels = np.zeros(len(paths), np.int64), []
    for depth in range(paths.shape[1]):
        keys, parent = np.unique(parent * 256 + paths[:, depth], return_inverse=True)
        levels.append(keys)
    return levels


def _expand(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry its number and a running number, ``sizes`` times."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Shard:
    """A shard's words as a trie, their hashes, and the best near word of each."""

    def __init__(self, values: pa.Array, n: np.ndarray):
        self.values, self.n, self.words = values, n, Words(values)
        self.paths, self.leaf = np.unique(self.words.path, axis=0, return_inverse=True)
        self.leaf = self.leaf.ravel()
        self.levels = trie(self.paths)
        key = mix(self.words.hashes[0] + self.words.length.astype(np.uint64))
        self.order = np.argsort(key)
        self.sorted = key[self.order]
        self.near, self.best = np.zeros(len(n), np.int64), Best(len(n))

    def matches(self, queries: Words) -> tuple[np.ndarray, np.ndarray]:
        """(query, word): pairs one edit apart, each once."""
        paths, of = np.unique(queries.path, axis=0, return_inverse=True)
        path, leaf, lost, gained = walk(self.levels, paths)
        # a replacement within one group of several letters keeps the vector
        same = np.nonzero(lost < 0)[0]
        accents = np.arange(26, LEVELS)
        kept = same[(paths[path[same]][:, 26:] > 0).any(axis=1)]
        path = np.concatenate([path[lost >= 0], np.repeat(path[kept], len(accents))])
        leaf = np.concatenate([leaf[lost >= 0], np.repeat(leaf[kept], len(accents))])
        lost, gained = (np.concatenate([x[lost >= 0], np.tile(accents, len(kept))]).astype(np.int64)
                        for x in (lost, gained))
        members = np.argsort(of.ravel(), kind="stable")
        sizes = np.bincount(of.ravel(), minlength=len(paths))
        start = np.cumsum(sizes) - sizes
        owner, k = _expand(sizes[path])
        word, leaf, lost, gained = members[start[path[owner]] + k], leaf[owner], lost[owner], gained[owner]
        out = [self._edited(queries, word, leaf, lost, gained, y) for y in range(max(map(len, LETTERS)))]
        return tuple(np.concatenate(x) for x in zip(*out))

    def _edited(self, queries: Words, word, leaf, lost, gained, nth: int):
        """Matches by the ``nth`` letter of the gained group (a deletion has none)."""
        table = np.array([[x[nth] if nth < len(x) else 0 for x in LETTERS]], np.int64)[0]
        letter = np.where(gained >= 0, table[gained], 0)
        use = (letter > 0) | ((gained < 0) & (nth == 0))
        word, leaf, lost, letter = word[use], leaf[use], lost[use], letter[use]
        owner, k = _expand(queries.count[word, lost])
        word, leaf, letter = word[owner], leaf[owner], letter[owner]
        place = queries.place[queries.first[word, lost[owner]] + k]
        old, end = queries.text[place].astype(np.int64), queries.start[word] + queries.length[word]
        delete = letter == 0
        after = queries.text[np.minimum(place + 1, len(queries.text) - 1)]
        # of equal letters in a row the last one goes; letters of one group change upwards
        ok = np.where(delete, (place + 1 == end) | (after != old),
                      (letter > old) | (GROUP[letter] != GROUP[old]))
        word, leaf, letter, place, old, end, delete = (
            x[ok] for x in (word, leaf, letter, place, old, end, delete))
        whole, prefix = queries.hashes
        at = place - queries.start[word]
        power = powers(int(queries.length.max(initial=0)))[at]
        changed = whole[word] + (letter - old).astype(np.uint64) * power
        left, right = prefix[place] - prefix[queries.start[word]], prefix[end] - prefix[place + 1]
        key = np.where(delete, left + right * INVERSE, changed)
        key = mix(key + (queries.length[word] - delete).astype(np.uint64))
        found = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
        hit = np.nonzero(self.sorted[found] == key)[0]
        other = self.order[found[hit]]
        hit, other = hit[self.leaf[other] == leaf[hit]], other[self.leaf[other] == leaf[hit]]
        keep = self._equal(queries, word[hit], place[hit], letter[hit], other)
        return word[hit][keep], other[keep]

    def _equal(self, queries: Words, word, place, letter, other) -> np.ndarray:
        """Whether the edited query words are the found words, letter by letter."""
        mine, delete = self.words, letter == 0
        size = mine.length[other]
        fits = size == queries.length[word] - delete
        owner, k = _expand(np.where(fits, size, 0))
        at = queries.start[word][owner] + k
        at += delete[owner] & (at >= place[owner])
        seen = np.where(~delete[owner] & (at == place[owner]), letter[owner], queries.text[at])
        wrong = seen != mine.text[mine.start[other][owner] + k]
        return fits & (np.bincount(owner[wrong], minlength=len(word)) == 0)


class Best:
    """Largest frequency, then smallest word, among the near words of each word."""

    def __init__(self, size: int):
        self.n, self.word = np.zeros(size, np.int64), np.full(size, None, object)

    def add(self, at: np.ndarray, n: np.ndarray, values: np.ndarray):
        # of each word's candidates only those of the largest frequency are compared as text
        top = self.n.copy()
        np.maximum.at(top, at, n)
        for i, m, w in zip(*(x[n == top[at]] for x in (at, n, values))):
            if m > self.n[i] or self.word[i] is None or w < self.word[i]:
                self.n[i], self.word[i] = m, w


FOUND = pa.schema([("word", pa.string()), ("near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _rows(values: pa.Array, near: np.ndarray, best: Best) -> pa.RecordBatch:
    has = np.nonzero(near)[0]
    return pa.RecordBatch.from_arrays([values.take(pa.array(has)), pa.array(near[has]), pa.array(best.n[has]),
                                       pa.array(best.word[has].tolist(), pa.string())], schema=FOUND)


def _search(batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, in each the words first and then the queries."""
        name, held, shard = None, [], None

        def parts():
            for b in batches:
                shards = b.column("shard").to_numpy(zero_copy_only=False)
                kinds = b.column("query").to_numpy(zero_copy_only=False)
                cuts = np.nonzero((shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1]))[0] + 1
                for a, e in zip([0, *cuts], [*cuts, b.num_rows]):
                    for at in range(a, e, batch):
                        size = min(batch, e - at)
                        yield shards[a], kinds[a], b.column("word").slice(at, size), b.column("n").slice(at, size)

        def done():
            if shard is not None:
                yield _rows(shard.values, shard.near, shard.best)

        for key, is_query, values, n in parts():
            if key != name:
                yield from done()
                name, held, shard = key, [], None
            if not is_query:
                held.append((values, n))
                continue
            if shard is None:
                if not held:
                    continue  # no word has this path
                shard = Shard(pa.concat_arrays([v for v, _ in held]), np.concatenate([n.to_numpy() for _, n in held]))
                texts, held = np.array(shard.values.to_pylist(), object), []
            query, word = shard.matches(Words(values))
            n, mine = n.to_numpy(), np.array(values.to_pylist(), object)
            near, best = np.bincount(query, minlength=len(mine)), Best(len(mine))
            best.add(query, shard.n[word], texts[word])
            yield _rows(values, near, best)
            shard.near += np.bincount(word, minlength=len(texts))
            shard.best.add(word, n[query], mine[query])
        yield from done()
    return run


def _paths(batches):
    for b in batches:
        paths = Words(b.column("word")).path
        flat = pa.array([p.tobytes() for p in paths], pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns, flat], [*b.schema.names, "path"])


def _route(full, blocks):
    def reached(path: bytes) -> list[bytes]:
        """Prefixes of shards that the walk reaches from a path."""
        out, todo = [], [(b"", False, False)]
        while todo:
            prefix, lost, gained = todo.pop()
            if prefix not in full.value:
                out.append(prefix)
                continue
            count = path[len(prefix)]
            todo.append((prefix + bytes([count]), lost, gained))
            if not lost and count:
                todo.append((prefix + bytes([count - 1]), True, False))
            if lost and not gained:
                todo.append((prefix + bytes([(count + 1) & 255]), True, True))
        return out

    def run(batches):
        deep = max(map(len, full.value), default=0) + 1
        memo: dict[bytes, list[bytes]] = {}
        for b in batches:
            shard, query, at = [], [], []
            paths, texts = b.column("path").to_pylist(), b.column("word").to_pylist()
            for i, path in enumerate(paths):
                short = path[:deep]
                if short not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    memo[short] = reached(path)
                for prefix in memo[short]:
                    n = blocks.value.get(prefix, 1)
                    own = path.startswith(prefix)
                    mine = sum(texts[i].encode()) % n if n > 1 else 0
                    for k in range(n):
                        name = prefix + b"/%d" % k
                        if own and k == mine:
                            shard.append(name)
                            query.append(False)
                            at.append(i)
                        shard.append(name)
                        query.append(True)
                        at.append(i)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.binary()), pa.array(query), b.column("word").take(take), b.column("n").take(take)],
                ["shard", "query", "word", "n"])
    return run


def near_words(vocabulary: DataFrame, shard_words: int = SHARD_WORDS, batch: int = BATCH) -> DataFrame:
    """(word, near, form_n, form): for words with near ones, their number, and the
    most frequent of them. ``vocabulary(word, n)`` has distinct words."""
    spark = vocabulary.sparkSession
    ship_package(spark)
    paths = written(vocabulary.mapInArrow(_paths, "word string, n bigint, path binary"), "paths")
    total = paths.count()
    limit = max(shard_words, total // MAX_SHARDS)
    full, blocks, n_shards = {b""}, {}, 1
    for depth in range(1, LEVELS + 1):
        # at most total / limit prefixes of a level come back
        found = [(bytes(r[0]), r[1]) for r in paths.groupBy(F.substring("path", 1, depth)).count()
                 .where(F.col("count") > limit).collect()]
        if depth < LEVELS:
            full |= {p for p, _ in found}
        else:
            blocks = {p: -(-n // limit) for p, n in found}
        n_shards += 4 * len(found)
        if not found:
            break
    shared = spark.sparkContext.broadcast(full), spark.sparkContext.broadcast(blocks)
    routed = paths.mapInArrow(_route(*shared), "shard binary, query boolean, word string, n bigint")
    n = max(spark.sparkContext.defaultParallelism * 4, min(n_shards, MAX_SHARDS))
    return (routed.repartition(n, "shard").sortWithinPartitions("shard", "query")
            .mapInArrow(_search(batch), "word string, near bigint, form_n bigint, form string")
            .groupBy("word").agg(F.sum("near").alias("near"),
                                 F.min(F.struct((-F.col("form_n")).alias("minus"), "form")).alias("best"))
            .select("word", "near", (-F.col("best.minus")).alias("form_n"), "best.form"))


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             shard_words: int = SHARD_WORDS, batch: int = BATCH) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary."""
    vocabulary = written(words(docs).where((F.char_length("word") >= min_length) & (F.col("n") >= min_count)),
                         "vocabulary")
    near = near_words(vocabulary, shard_words, batch)
    formed = F.col("form_n") >= ratio * F.col("n")
    table = written(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "forms")
    top = written(table.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        up = top.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(top.join(up, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        top = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return table.join(top, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
