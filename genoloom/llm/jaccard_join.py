"""N-gram Jaccard join with multiple-global-order filtering, and the groups it links.

Documents are sets of word shingles; two link when their Jaccard similarity reaches the bound. Two
such sets must share a token among the first ``n - ceil(bound * n) + 1`` of each set, under any order
of all tokens. Three orders are used. Under the first, rising frequency (from a count sketch over
all documents), candidates are found by joining prefix tokens. Under the other two, the rising and
falling hash, a candidate pair must share prefix tokens as well; a parity bitmap of each set bounds
the difference of the two before that. What passes all filters is compared set against set.

Groups are found without all pairs of a large one: documents with equal sets are one class. First
every class meets, per shared token, only the token's pivot. Links join classes into components, and
only classes of different components that share a token are compared further: first as many pairs
per token as could tie its components together, at last every pair that is still in different
components. A group of near copies that has grown together costs nothing more, and no link between
different components is left out, hence the components are those of all links.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import may_hold, orderable, quoted, settle, whole
from genoloom.llm.components import components
from genoloom.llm.tokens import held, slices, values

SHINGLE = 5
PERCENT = 75
CELL_BITS = 20  # the sketch has 2^20 cells, 4 MB; more cells find rarer frequent tokens
BLOCKS = 64  # the sketch travels in so many parts
SHORT_BITS = 12  # parity bits that travel with a token's classes at most; full bitmaps follow for the pairs left
LEAST_BITS, MOST_BITS = 10, 16  # a set has 2^10 to 2^16 parity bits, two or more a token up to 32,768 tokens
GROUP = 4096  # classes of one token that one comparison holds; larger groups are cut into blocks

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _combined(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the windows of ``size`` word hashes."""
    n = len(hashes) - size + 1
    out = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * _MIX + hashes[k : k + n]
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes. A text of fewer words is one shingle, one without words none."""
    words = text.encode().lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    return np.unique(_combined(hashes, min(size, len(hashes))))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def bitmap_level(n: np.ndarray) -> np.ndarray:
    """Log2 of the number of parity bits of sets of ``n`` tokens."""
    return np.clip(np.ceil(np.log2(np.maximum(2 * n, 1))), LEAST_BITS, MOST_BITS).astype(np.int64)


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bitmap with a bit for each place that an odd number of tokens falls on. The exclusive or of its
    halves is the bitmap of half as many places."""
    places = 1 << int(bitmap_level(np.array(len(tokens))))
    at = (tokens & np.uint64(places - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=places).astype(np.uint8) & 1).view("<u8")


def set_class(tokens: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set, which names its class."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


_SCAN = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("bits", pa.binary()),
                   ("block", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class, size and bitmap of every text, then the task's token counts by cell of the sketch."""
    held()
    cells = 1 << CELL_BITS
    counts = np.zeros(cells, np.int64)
    for batch in batches:
        named, sizes, bits, waiting, size = [], [], [], [], 0
        for part in slices(values(batch.column(2))):
            for text in part:
                s = shingles(text)
                named.append(set_class(s) if len(s) else None)
                sizes.append(len(s))
                bits.append(parity(s).tobytes() if len(s) else None)
                waiting.append(s >> np.uint64(64 - CELL_BITS))
                size += len(s)
            if size > cells:
                counts += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=cells)
                waiting, size = [], 0
        if waiting:
            counts += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=cells)
        none = [None] * batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(named, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()),
             pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=_SCAN)
    part = TaskContext.get().partitionId() % BLOCKS
    rows = [(b, c) for b, c in enumerate(counts.reshape(BLOCKS, -1)) if c.any()]
    none = [None] * len(rows)
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(none, t) for t in _SCAN.types[:5]), pa.array([b for b, _ in rows], pa.int32()), pa.array([part] * len(rows), pa.int32()),
         pa.array([zlib.compress(c.astype("<i8").tobytes(), 1) for _, c in rows], pa.binary())], schema=_SCAN)


def _add_counts(table: pa.Table) -> pa.Table:
    total = 0
    for c in table["counts"]:
        total = total + np.frombuffer(zlib.decompress(c.as_py()), "<i8")
    first = table.slice(0, 1)
    return pa.table({"block": first["block"], "part": first["part"], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _sketch(scan: DataFrame) -> np.ndarray:
    """Token counts by cell: tasks' counts are added per block in two levels; 2^20 cells reach the driver."""
    counts, schema = scan.where("counts IS NOT NULL").select("block", "part", "counts"), "block int, part int, counts binary"
    some = counts.groupBy("block", "part").applyInArrow(_add_counts, schema)
    out = np.zeros((BLOCKS, (1 << CELL_BITS) // BLOCKS), np.int64)
    for row in some.groupBy("block").applyInArrow(_add_counts, schema).collect():
        out[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return out.reshape(-1)


def _shared_prefix_tokens(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(token, class) of prefix tokens, under rising frequency, that two or more classes have; settled."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held()
        count = shared.value
        for batch in batches:
            done: set[int] = set()  # copies in the batch are taken once
            for part in slices(values(batch.column(0))):
                tokens, owners = [], []
                for text in part:
                    s = shingles(text)
                    if not len(s) or (c := set_class(s)) in done:
                        continue
                    done.add(c)
                    rank = count[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    first = s[np.argsort(rank, kind="stable")[: prefix_length(len(s))]]
                    tokens.append(first)
                    owners.append(np.full(len(first), c, np.int64))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners))], names=["token", "class"])

    rows = docs.select(whole("text").alias("text")).mapInArrow(prefixes, "token long, class long")
    rows = rows.repartition("token").sortWithinPartitions("token", "class")
    return settle(rows.mapInArrow(_several, "token long, class long"))


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, class), each distinct row whose token has two or more classes.

    Between batches only the last row is carried, and whether it was passed on.
    """
    last, passed = None, False
    for batch in batches:
        token, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if last is not None:
            token, own = np.r_[last[0], token], np.r_[last[1], own]
        new = np.r_[True, (token[1:] != token[:-1]) | (own[1:] != own[:-1])]
        token, own = token[new], own[new]
        if not len(token):
            continue
        same = token[1:] == token[:-1]
        keep = np.r_[False, same] | np.r_[same, False]
        if passed and len(token):
            keep[0] = True
        end = bool(keep[-1])
        if passed:
            keep[0] = False
        last, passed = (token[-1], own[-1]), end
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(own[keep])], names=["token", "class"])


def _folded(bits: bytes, words: int) -> np.ndarray:
    """A bitmap at ``words`` 64-bit words, or its own size if that is less."""
    folded = np.frombuffer(bits, "<u8")
    while len(folded) > words:
        folded = folded[: len(folded) // 2] ^ folded[len(folded) // 2 :]
    return folded


def _difference_fits(bits: list[bytes], n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int = PERCENT, most: int = MOST_BITS) -> np.ndarray:
    """Pairs whose sizes and bitmaps allow the similarity: |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|).

    Bitmaps of different sizes are compared at the smaller one, those of more than 2^``most`` bits at that.
    """
    ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    level = np.minimum(bitmap_level(n), most)
    common = np.minimum(level[i], level[j])
    for size in np.unique(common[ok]).tolist():
        at = np.flatnonzero(ok & (common == size))
        rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        words = (1 << size) // 64
        maps = np.empty((len(rows), words), np.uint64)
        for k, r in enumerate(rows.tolist()):
            maps[k] = _folded(bits[r], words)
        x, y = place[: len(at)], place[len(at) :]
        step = max(1, (1 << 19) // words)
        for start in range(0, len(at), step):
            k = at[start : start + step]
            apart = np.bitwise_count(maps[x[start : start + step]] ^ maps[y[start : start + step]]).sum(1, dtype=np.int64)
            ok[k] = (100 + percent) * apart <= (100 - percent) * (n[i[k]].astype(np.int64) + n[j[k]])
    return ok


def _sizes_fit(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can reach the similarity."""
    return 100 * F.least(n, m).cast("long") >= PERCENT * F.greatest(n, m).cast("long")


def _with_pivots(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, class, n, pivot, n_pivot): a token's pivot is its class of least hash; settled without the pivots' own rows."""
    shared = shared.join(classes.select("class", "n"), "class")
    pivots = shared.groupBy("token").agg(F.min(F.struct(F.xxhash64("class").alias("o"), F.col("class").alias("pivot"), F.col("n").alias("n_pivot"))).alias("p"))
    return settle(shared.join(pivots.select("token", "p.pivot", "p.n_pivot"), "token").where("class != pivot"))


def _fitting(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) as far as sizes and bitmaps allow; settled."""
    side = classes.select("class", "n", "bits")
    for end in "ab":
        pairs = pairs.join(side.select(F.col("class").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}")), end)

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            bits = [*batch.column(2).to_pylist(), *batch.column(3).to_pylist()]
            n = np.concatenate([batch.column(4).to_numpy(), batch.column(5).to_numpy()]).astype(np.int64)
            ok = _difference_fits(bits, n, np.arange(m), np.arange(m) + m)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return settle(pairs.select("a", "b", "bits_a", "bits_b", "n_a", "n_b").mapInArrow(fitting, "a long, b long"))


def _forest(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positions of pairs that tie together components (x, y) not yet tied in their group."""
    keep, tied, now = [], {}, None
    for k, (g, a, b) in enumerate(zip(group.tolist(), x.tolist(), y.tolist(), strict=True)):
        if g != now:
            tied, now = {}, g
        while (up := tied.get(a, a)) != a:
            a = up
        while (up := tied.get(b, b)) != b:
            b = up
        if a != b:
            tied[max(a, b)] = min(a, b)
            keep.append(k)
    return np.array(keep, np.int64)


def _group_pairs(batches: Iterator[pa.RecordBatch], forest: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, i, j): the pairs of each group that different components and bitmaps leave,
    or with ``forest`` only as many as tie the group's components together.

    A group holds the classes of a token in its block i (side 0) and block j (side 1) or, if i = j,
    in one block; two blocks at most are held at a time.
    """
    def pairs(table: pa.Table) -> pa.RecordBatch:
        token, bi, bj, side = (table[c].to_numpy() for c in ("token", "i", "j", "side"))
        own, comp, n = (table[c].to_numpy() for c in ("class", "comp", "n"))
        bits = table["bits"].to_pylist()
        new = np.r_[True, (token[1:] != token[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])]
        group, starts = np.cumsum(new), np.r_[np.flatnonzero(new), len(token)]
        out, some, held = [], [], 0

        def flush() -> None:
            nonlocal some, held
            if some:
                i, j = (np.concatenate(x) for x in zip(*some, strict=True))
                ok = (comp[i] != comp[j]) & ((side[i] != side[j]) | (bi[i] == bj[i]))
                i, j = i[ok], j[ok]
                fit = np.flatnonzero(_difference_fits(bits, n, i, j, most=SHORT_BITS))
                if forest:
                    fit = fit[_forest(group[i[fit]], comp[i[fit]], comp[j[fit]])]
                a, b = own[i[fit]], own[j[fit]]
                if len(a):
                    out.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1))
                some, held = [], 0

        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if e - s < 2:
                continue
            step = max(1, 1_000_000 // (e - s))
            for lo in range(s, e, step):
                rows = np.arange(lo, min(lo + step, e))
                i = np.repeat(rows, e - 1 - rows)
                j = np.concatenate([np.arange(r + 1, e) for r in rows.tolist()])
                some.append((i, j))
                held += len(i)
                if held > 500_000:
                    flush()
        flush()
        found = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    waiting: list[pa.Table] = []
    for batch in batches:
        waiting.append(pa.Table.from_batches([batch]))
        table = pa.concat_tables(waiting)
        last = [table[c][-1].as_py() for c in ("token", "i", "j")]
        same = np.ones(len(table), bool)
        for c, v in zip(("token", "i", "j"), last, strict=True):
            same &= table[c].to_numpy() == v
        cut = int(np.argmax(same))  # sorted: the last group begins here
        if cut:
            yield pairs(table.slice(0, cut))
        waiting = [table.slice(cut)]
    if waiting:
        yield pairs(pa.concat_tables(waiting))


def _short(classes: DataFrame) -> DataFrame:
    """(class, bits) with bitmaps of at most 2^SHORT_BITS bits."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [_folded(b.as_buffer(), (1 << SHORT_BITS) // 64).tobytes() for b in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["class", "bits"])

    return classes.select("class", "bits").mapInArrow(fold, "class long, bits binary")


def _cross_pairs(members: DataFrame, classes: DataFrame, links: DataFrame, forest: bool) -> DataFrame:
    """(a, b) of classes in different components of ``links`` that share a token, as far as size and
    short bitmap allow; with ``forest`` only some, enough to tie each token's components. A token of two
    classes is left out where their sizes tell them apart.

    A token's classes are dealt over blocks of about ``GROUP`` by a hash; each two blocks meet in a
    group of their own, so no task holds more than two blocks of a frequent token.
    """
    labels = settle(components(links)).withColumnRenamed("node", "class")
    named = settle(members.select("token", "class", "n").join(labels, "class", "left").select("token", "class", "n", F.coalesce("label", "class").alias("comp")))
    mixed = named.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("k"),
                                       F.min("n").alias("least"), F.max("n").alias("most"))
    mixed = mixed.where((F.col("x") < F.col("y")) & ((F.col("k") > 2) | _sizes_fit(F.col("least"), F.col("most"))))
    mixed = settle(mixed.select("token", F.ceil(F.col("k") / GROUP).cast("int").alias("m")))
    rows = named.join(mixed, "token").join(_short(classes), "class")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class", "token"), F.col("m")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    rows = rows.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "class", "comp", "n", "bits")
    grouped = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return settle(grouped.mapInArrow(lambda batches: _group_pairs(batches, forest), "a long, b long").distinct())


def _same_enough(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """The second and third order's filters on the whole prefixes, then the exact comparison."""
    la, lb = prefix_length(len(a), percent), prefix_length(len(b), percent)
    for pa_, pb in ((a[:la], b[:lb]), (a[-la:], b[-lb:])):
        if not len(np.intersect1d(pa_, pb, assume_unique=True)):
            return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit hash of a row's doc_id and text, by which rows are found again."""
    return F.xxhash64(F.col(doc_id).cast("long"), whole(text))


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that link, settled. Only texts of the pairs' classes are fetched and shuffled."""
    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = settle(ends.join(classes.select("class", "tkey"), "class"))
    texts = may_hold(docs.select(_row_key().alias("tkey"), whole("text").alias("text")), wanted, "may").where("may").select("tkey", "text")
    texts = texts.join(wanted, "tkey").groupBy("tkey", "class").agg(F.first("text").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [s.tobytes() for part in slices(values(batch.column(1))) for s in map(shingles, part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], names=["class", "tokens"])

    held = settle(texts.select("class", "text").mapInArrow(sets, "class long, tokens binary"))
    for end in "ab":
        pairs = pairs.join(held.select(F.col("class").alias(end), F.col("tokens").alias(f"tokens_{end}")), end)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_same_enough(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"))
                  for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return settle(pairs.select("a", "b", "tokens_a", "tokens_b").mapInArrow(compare, "a long, b long"))


@dataclass
class Linked:
    """``members``: doc_id, tkey, n_shingles, class, label and component_id of every row.
    ``links``: (a, b) of linked classes, enough to join every group; copies are one class."""

    members: DataFrame
    links: DataFrame


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Linked:
    """Link every two documents whose shingle sets are at least 75 percent alike, directly or in a chain.

    ``component_id`` is the smallest doc_id of the group; rows without words (a null text is empty)
    are linked with nothing and keep their own doc_id. Rows sharing a doc_id are documents of their
    own; a null doc_id is never the smallest, and a group of null doc_ids has a null component.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scan = settle(docs.select("doc_id", _row_key().alias("tkey"), whole("text").alias("text")).mapInArrow(
        _scan, "doc_id long, tkey long, class long, n int, bits binary, block int, part int, counts binary"))
    rows = scan.where("counts IS NULL")
    classes = settle(rows.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.min("tkey").alias("tkey"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    members = _with_pivots(_shared_prefix_tokens(docs, _sketch(scan)), classes)
    pairs = members.where(_sizes_fit(F.col("n"), F.col("n_pivot"))).select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")).distinct()
    links = _linked(docs, classes, _fitting(pairs, classes))
    for forest in (True, False):
        pairs = _fitting(_cross_pairs(members, classes, links, forest), classes)
        links = settle(links.unionByName(_linked(docs, classes, pairs)))
    labels = settle(components(links))
    groups = settle(classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "class", F.coalesce("label", "class").alias("label"), "least"))
    least = groups.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = settle(groups.select("class", "label").join(least, "label"))
    members = rows.select("doc_id", "tkey", F.col("n").cast("long").alias("n_shingles"), "class")
    members = members.join(groups, "class", "left").withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return Linked(members, links)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, all columns: of each group the row with the smallest doc_id.

    Rows of groups of one are not shuffled; the others' best row is a grouping, which takes copies
    together in the map tasks. Null doc_ids come last; ties go to the smallest remaining columns.
    """
    members = settle(link_documents(docs, doc_id, text).members.where("class IS NOT NULL").select("tkey", "label"))
    several = members.groupBy("label").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("label")
    keyed = settle(members.join(several, "label", "left_semi").distinct())
    rows = docs.select(F.struct(*quoted(docs.columns)).alias("row"), _row_key(doc_id, text).alias("tkey"))
    marked = may_hold(rows, keyed, "may")
    suspects = marked.where("may").join(keyed, "tkey", "left")
    order = [F.col(f"row.`{doc_id}`").isNull().alias("o"), F.col(f"row.`{doc_id}`").alias("i"),
             *(F.col(f"row.{c}").alias(f"c{k}") for k, c in enumerate(orderable(docs)))]
    best = suspects.where("label IS NOT NULL").groupBy("label").agg(F.min_by("row", F.struct(*order)).alias("row"))
    return (marked.where("NOT may").select("row").unionByName(suspects.where("label IS NULL").select("row"))
            .unionByName(best.select("row")).select("row.*"))
