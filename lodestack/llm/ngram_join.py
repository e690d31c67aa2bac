"""N-gram Jaccard self-join with parity sketches: exact links at 0.8 and their components.

Every distinct 5-word shingle is a token with a 64-bit address. A document's parity sketch flips the bit at each
token's address, so two sketches differ in at most as many bits as the token sets do. Within a size band the sketch
is cut into P blocks of hashed positions, and a block is kept as the XOR of the addresses of its set bits. Jaccard
>= 0.8 bounds the symmetric difference by D = a / 4 for the smaller set's size a, so at least P - D blocks agree
(pigeonhole); blocks that are empty on both sides say nothing and are not sent. A document with too many empty blocks to be sure of a
filled one among the P - D repeats under further seeds, and under the last seed sends its empty blocks too. So
no pair is missed. Tokens that very many documents hold are left out of the first seed's blocks (see signatures). Documents that meet in a block are candidates; candidates are verified on their whole token sets.

The candidates of a block are first compared with one pivot (a star): the one that is in most blocks, as the text that
copies were made from is, so most groups become one component. What a star leaves in several components is compared by
whole parity sketches of 2 to 4 bits a token, whose Hamming distance is a lower bound of the symmetric difference and so
rules out nearly all pairs; only the others are ever rows. Sketches are compared in tiles of a bounded number of members.

Equal sets (copies) are one vertex throughout, so a group of copies of any size costs one entry a task. Signatures
travel as packed arrays of 16 bytes an entry, dealt by the signature's leading bits. One signature's different near copies
meet in one task, some 70 bytes each with the sort's copies, so ten million variants of one text take about 700 MB there; beyond it
a group leaves in slices of SLICE members.

Sets are told apart by 64 bits: among n different ones n * n / 2**65 pairs are expected to be taken for equal, 1e-5 for the
25 million documents of 60 GB, two or three for ten billion documents.

Cases: a null text is empty: no shingles, linked with nothing; with one to four words the whole sequence is the one
shingle; sets below four shingles link only with equal ones, which the bound says too; null ids are members but
never a component's id unless all are null; repeated rows are copies; texts of any length
are cut into shingles whole, one at a time; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .components import components
from .shared import small, table

WORDS = 5
SEEDS = 3
#: Documents in the sample that the list of common tokens is taken from, and how many of them must hold one.
SAMPLE = 20_000
COMMON = 5
GROWTH = 1.6
#: Entries of 16 bytes that a worker gathers before it deals them out, and aims to have in a bucket.
FLUSH = 250_000
BUCKET = 500_000
#: Members of a group in one row; a larger group is several rows.
SLICE = 8192
BLOCK_CHARS = 1 << 20
MEMO = 100_000
#: Members in a slice of an open group; a tile holds two slices.
TILE = 4096
#: Bits of the smallest parity sketch.
LEAST_BITS = 256

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply, twice)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


#: One odd factor for each place in a shingle; they must not be linear in the place.
_FACTORS = [x | np.uint64(1) for x in mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(_STEP))]


def bands() -> np.ndarray:
    """Lower bounds of the size bands, from 4 on; the last exceeds any size."""
    out = [4]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * GROWTH)))
    return np.array(out, dtype=np.int64)


BANDS = bands()


def band_plan(band: int) -> tuple[int, int]:
    """(largest symmetric difference D, blocks P) for pairs whose smaller set lies in the band."""
    differ = (int(BANDS[band + 1]) - 1) // 4
    return differ, differ + 5 + differ * 16 // 100


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct token addresses of texts."""

    def __init__(self):
        self.hashes = _Hashes()

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        # bytes.lower changes A-Z only and bytes.split() splits at the six blanks only
        words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        get, flat = self.hashes.__getitem__, []
        for w in words:
            flat += map(get, w)
        base = mix(np.array(flat, dtype=np.uint64))
        n = max(0, len(base) - WORDS + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        for i, factor in enumerate(_FACTORS):
            rolled += base[i : i + n] * factor
        rolled = mix(rolled)
        out, at = [], 0
        for w in words:
            k = len(w)
            if k >= WORDS:
                one = np.unique(rolled[at : at + k - WORDS + 1])
            elif k:
                short = np.zeros(1, dtype=np.uint64)
                for i in range(k):
                    short += base[at + i : at + i + 1] * _FACTORS[i]
                one = mix(short + np.uint64(k))
            else:
                one = base[:0]
            out.append(one)
            at += k
        return out


def set_id(tokens: np.ndarray) -> int:
    """64-bit digest of a set, as a signed long; 0 for the empty set."""
    if not len(tokens):
        return 0
    total = np.add.reduce(mix(tokens + np.uint64(_STEP)))
    folded = np.bitwise_xor.reduce(mix(tokens ^ _M1))
    return int(mix(np.array([total], dtype=np.uint64) + mix(np.array([folded], dtype=np.uint64) + np.uint64(len(tokens)))).view(np.int64)[0])


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """64-bit words of the sketch: one flip a token, a power of two of bits and at least two for each token."""
    bits = LEAST_BITS
    while bits < 2 * len(tokens):
        bits *= 2
    at = mix(tokens + np.uint64(7)) & np.uint64(bits - 1)
    flips = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch with fewer bits: halves are XORed, as if the addresses had been shorter."""
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def signatures(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """All block signatures of a set, over the bands where it can be the smaller or the larger side.

    Tokens of ``common`` are left out first, on both sides alike: that can only shrink the symmetric difference, so the
    bound holds for any such list, and blocks that hold nothing but a common passage are not sent. A set with too
    many empty blocks without them also sends blocks of all its tokens, and meets the sets like itself there."""
    n = len(tokens)
    if n < 4:
        return tokens[:0]
    rare = tokens
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        rare = tokens[common[at] != tokens]
    own = int(np.searchsorted(BANDS, n, "right")) - 1
    lowest = int(np.searchsorted(BANDS, -(-4 * n // 5), "right")) - 1  # the band of the least partner
    found = []
    for band in range(max(0, lowest), own + 1):
        differ, blocks = band_plan(band)
        for seed in range(SEEDS + 1):
            use = tokens if seed else rare
            tag = np.uint64(((band * (SEEDS + 1) + seed + 1) * _STEP) & 0xFFFFFFFFFFFFFFFF)
            at = ((mix(use ^ tag) >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
            order = np.argsort(at, kind="stable")
            at = at[order]
            filled = at[:0]
            if len(at):
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                filled = at[first]
                found.append(mix(np.bitwise_xor.reduceat(use[order], first) + mix(filled + tag)))
            if blocks - len(filled) < blocks - differ:  # some agreeing block is surely filled
                break
            if seed == SEEDS:
                empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), filled, assume_unique=True)
                found.append(mix(mix(empty + tag)))
    return np.concatenate(found)


def common_tokens(docs: DataFrame, id_col: str, text_col: str, rows: int) -> np.ndarray:
    """Tokens that at least COMMON of about SAMPLE documents hold, sorted. A list for speed only: the result is the same
    with any list, so a bounded sample by the hash of the id is enough."""
    step = max(1, rows // SAMPLE)

    def run(batches):
        import pyarrow as pa

        shingler, held, size = Shingler(), [], 0

        def flush():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n, pa.int64())], names=["token", "n"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in _blocks(texts):
                for one in shingler.sets(texts[a:b]):
                    held.append(one)
                    size += len(one)
                if size > FLUSH:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    sample = docs.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(step)) == 0).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = sample.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON)
    return np.sort(counts.select("token").toPandas()["token"].to_numpy(dtype=np.int64).view(np.uint64))


def _blocks(texts):
    """Slices of a list of texts with about BLOCK_CHARS characters each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, sid of every document."""

    def run(batches):
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            texts, n, sids = batch.column(1).to_pylist(), [], []
            for a, b in _blocks(texts):
                for tokens in shingler.sets(texts[a:b]):
                    n.append(len(tokens))
                    sids.append(set_id(tokens))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sids, pa.int64())], names=["doc_id", "n", "sid"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, sid long")


def candidate_groups(docs: DataFrame, text_col: str, tokens: int, common: np.ndarray) -> DataFrame:
    """gid, slice, members: sorted set ids that agree in a block, at most SLICE of them in a row."""
    bits = 6
    while (1 << bits) * BUCKET < tokens // 2:
        bits += 1

    def deal(batches):
        import pyarrow as pa

        shingler, sigs, sids, held, seen = Shingler(), [], [], 0, set()

        def flush():
            sig = np.concatenate(sigs)
            sid = np.repeat(np.array([s for s, _ in sids], dtype=np.int64), [k for _, k in sids])
            bucket = (sig >> np.uint64(64 - bits)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            sig, sid, bucket = sig[order], sid[order], bucket[order]
            first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            ends = np.append(first[1:], len(sig))
            rows = [(int(bucket[a]), sig[a:b].tobytes(), sid[a:b].tobytes()) for a, b in zip(first, ends)]
            sigs.clear()
            sids.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "sigs", "sids"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in _blocks(texts):
                for one in shingler.sets(texts[a:b]):
                    sid = set_id(one)
                    if sid in seen:  # copies in the same task: sent once
                        continue
                    if len(seen) > MEMO:
                        seen.clear()
                    seen.add(sid)
                    sig = signatures(one, common)
                    if len(sig):
                        sigs.append(sig)
                        sids.append((sid, len(sig)))
                        held += len(sig)
                if held >= FLUSH:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    def meet(group):
        import pyarrow as pa

        sig = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group.column("sigs")])
        sid = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int64) for x in group.column("sids")])
        order = np.argsort(sig)
        sig, sid = sig[order], sid[order]
        same = sig[1:] == sig[:-1]
        many = np.concatenate((same, [False])) | np.concatenate(([False], same))
        sig, sid = sig[many], sid[many]
        order = np.lexsort((sid, sig))
        sig, sid = sig[order], sid[order]
        if len(sig):
            fresh = np.concatenate(([True], (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])))
            sig, sid = sig[fresh], sid[fresh]
        first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, dtype=np.int64)
        ends = np.append(first[1:], len(sig)).astype(np.int64)
        import xxhash

        gids, slices, members, seen = [], [], [], set()
        for a, b in zip(first.tolist(), ends.tolist()):
            if b - a > 1 and (gid := xxhash.xxh64_intdigest(sid[a:b].tobytes()) - (1 << 63)) not in seen:
                seen.add(gid)  # the same group in several blocks
                for k, low in enumerate(range(a, b, SLICE)):
                    gids.append(gid)
                    slices.append(k)
                    members.append(sid[low : min(b, low + SLICE)])
        return pa.table({"gid": pa.array(gids, pa.int64()), "slice": pa.array(slices, pa.int32()), "members": pa.array(members, pa.list_(pa.int64()))})

    dealt = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(deal, "bucket int, sigs binary, sids binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "gid long, slice int, members array<long>").distinct()


def token_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """sid, tokens (packed addresses), sketch of one document for every wanted (rep_id, sid)."""

    def packed_batch(found):
        import pyarrow as pa

        sids, sets = [s for s, _ in found], [t for _, t in found]
        columns = [pa.array(sids, pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary()), pa.array([parity_sketch(t).tobytes() for t in sets], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["sid", "tokens", "sketch"])

    def run(batches):
        shingler, seen, found = Shingler(), set(), []
        for batch in batches:
            want, texts = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for a, b in _blocks(texts):
                for sid, tokens in zip(want[a:b], shingler.sets(texts[a:b])):
                    if sid == set_id(tokens) and sid not in seen:
                        seen.add(sid)
                        found.append((sid, tokens))
                if sum(len(t) for _, t in found) > FLUSH:
                    yield packed_batch(found)
                    found = []
                    if len(seen) > MEMO:  # a set that comes again makes the same links again
                        seen.clear()
        yield packed_batch(found)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(small(wanted), F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("text", "sid")
    return rows.mapInArrow(run, "sid long, tokens binary, sketch binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets reach 0.8: 100 * intersection >= 80 * union."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = [], []
            for x, y, tx, ty in zip(*(batch.column(k) for k in range(4))):
                s, t = np.frombuffer(tx.as_buffer(), dtype=np.uint64), np.frombuffer(ty.as_buffer(), dtype=np.uint64)
                if 100 * min(len(s), len(t)) < 80 * max(len(s), len(t)):
                    continue
                both = np.concatenate((s, t))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= 80 * (len(s) + len(t) - common):
                    a.append(x.as_py())
                    b.append(y.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("tokens_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "tokens_a", "tokens_b")
    return joined.mapInArrow(run, "a long, b long")


def survivors(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of groups that are in several components, other than those that their sketches rule out.

    Jaccard >= 0.8 means 9 * symmetric difference <= sum of the sizes, and the sketches' Hamming distance is never above
    the symmetric difference. A group is cut into slices of about TILE members and each two slices meet in a tile, so
    no task holds a whole group. Members of the group's main component are not compared with each other."""

    def compare(key, tile):
        import pyarrow as pa

        sid, label = tile.column("sid").to_numpy(), tile.column("label").to_numpy()
        part, n = tile.column("part").to_numpy(), tile.column("n").to_numpy()
        raw = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in tile.column("sketch")]
        words = min(map(len, raw))
        sketch = np.array([folded(x, words) for x in raw])
        kinds, counts = np.unique(label, return_counts=True)
        main = label == kinds[counts.argmax()]
        order = np.argsort(main, kind="stable")  # the main component last: its members are only right sides
        sid, label, part, n, sketch = sid[order], label[order], part[order], n[order], sketch[order]
        across, a, b = key[1].as_py() != key[2].as_py(), [], []
        for i in range(int((~main).sum())):
            apart = np.bitwise_count(sketch[i + 1 :] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            near = (9 * apart <= n[i + 1 :] + n[i]) & (label[i + 1 :] != label[i])
            if across:
                near &= part[i + 1 :] != part[i]
            at = np.flatnonzero(near) + i + 1
            a.append(np.minimum(sid[at], sid[i]))
            b.append(np.maximum(sid[at], sid[i]))
        none = [sid[:0]]
        return pa.table({"a": pa.array(np.concatenate(none + a), pa.int64()), "b": pa.array(np.concatenate(none + b), pa.int64())})

    of = small(labels.select(F.col("v").alias("sid"), "label"))
    placed = members.join(of, "sid", "left").select("gid", "sid", F.coalesce("label", "sid").alias("label"))
    open_ = placed.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
    open_ = table(open_.filter("low <> high and size > 2"), "join-open")  # of two members the star left no pair
    parts = F.ceil(F.col("size") / TILE).cast("int")
    rest = placed.join(small(open_), "gid").select("gid", "sid", "label", parts.alias("parts"))
    rest = rest.withColumn("part", F.pmod(F.xxhash64("sid"), "parts").cast("int"))
    rest = rest.select("gid", "sid", "label", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    rest = rest.select("gid", "sid", "label", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    rest = rest.join(sets.select("sid", "sketch", (F.octet_length("tokens") / 8).cast("long").alias("n")), "sid")
    return rest.groupBy("gid", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def similar_sets(docs: DataFrame, described: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """v, label for every set that links with another one: label is the component's smallest set id."""
    totals, rows = described.agg(F.sum("n"), F.count(F.lit(1))).first()
    common = common_tokens(docs, id_col, text_col, rows)
    groups = table(candidate_groups(docs, text_col, totals or 0, common), "join-groups")
    members = groups.select("gid", F.explode("members").alias("sid"))
    blocks = table(members.groupBy("sid").agg(F.count(F.lit(1)).alias("blocks")), "join-blocks")
    first_id = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))["id"]
    reps = described.groupBy("sid").agg(first_id.alias("rep_id"))
    wanted = table(blocks.join(reps, "sid").select("rep_id", "sid"), "join-wanted")
    sets = table(token_sets(docs, wanted, id_col, text_col), "join-sets")

    pivots = members.join(small(blocks), "sid").groupBy("gid").agg(F.max_by("sid", F.struct("blocks", "sid")).alias("pivot"))
    star = groups.join(pivots, "gid").select(F.col("pivot").alias("a"), F.explode("members").alias("b")).filter("a <> b")
    star = table(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "join-star")
    links = table(verified(star, sets), "join-links")
    labels = components(links)
    rest = table(survivors(members, labels, sets).join(star, ["a", "b"], "left_anti"), "join-rest")
    more = table(verified(rest, sets), "join-more")
    return components(links.unionByName(more)) if more.limit(1).count() else labels


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, sid of every document, and for those in a group of several its component_id and keep_sid.

    A group's document that stays has the smallest id, an id before none, and the smallest set id among equal ids."""
    described = table(describe(docs, id_col, text_col), "join-described")
    labels = similar_sets(docs, described, id_col, text_col)
    of = small(labels.select(F.col("v").alias("sid"), "label"))
    first = described.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    placed = first.join(of, "sid", "left").select("sid", "least", "copies", F.coalesce("label", "sid").alias("label"))
    placed = table(placed, "join-placed")
    best = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "sid"))
    ids = placed.groupBy("label").agg(best.alias("best"), F.sum("copies").alias("size")).filter("size > 1")
    ids = ids.select("label", F.col("best.least").alias("component_id"), F.col("best.sid").alias("keep_sid"))
    joined = table(placed.join(small(table(ids, "join-ids")), "label").select("sid", "component_id", "keep_sid"), "join-components")
    return described.join(small(joined), "sid", "left")


def clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), sid."""
    out = _placed(docs, id_col, text_col)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "sid")


def with_set_ids(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with the set id of the text as the column __sid."""
    place = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            texts = [x or "" for x in batch.column(place).to_pylist()]
            sids = [set_id(tokens) for a, b in _blocks(texts) for tokens in shingler.sets(texts[a:b])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sids, pa.int64())], names=[*batch.schema.names, "__sid"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__sid", LongType())]))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group and all documents outside groups, all columns as they came.

    Rows go by id. Where an id, or a missing one, has rows that go and rows that stay, they go by id and set id, so
    that each text is judged by itself. Rows that agree in both stay or go together."""
    stays = F.col("keep_sid").isNull() | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("sid") == F.col("keep_sid")))
    marks = table(_placed(docs, id_col, text_col).select("doc_id", "sid", (~stays).alias("goes")), "join-marks")
    ids = marks.groupBy(F.col("doc_id").alias("__id")).agg(F.max("goes").alias("some"), F.min("goes").alias("all")).filter("some")
    ids = table(ids, "join-gone")
    same = lambda df, other: df[id_col].cast("long").eqNullSafe(other["__id"])
    mixed = ids.filter("not all").select("__id")
    if not (n := mixed.count()):
        gone = small(ids.select("__id"))
        return docs.join(gone, same(docs, gone), "left_anti")
    every, mixed = small(ids.select("__id")), small(mixed, n)
    judged = with_set_ids(docs.join(mixed, same(docs, mixed), "left_semi"), text_col)
    gone = marks.filter("goes").select(F.col("doc_id").alias("__gone_id"), F.col("sid").alias("__gone_sid")).distinct()
    gone = small(table(gone, "join-gone-sets"))
    judged = judged.join(gone, judged[id_col].cast("long").eqNullSafe(gone["__gone_id"]) & (judged["__sid"] == gone["__gone_sid"]), "left_anti")
    return docs.join(every, same(docs, every), "left_anti").unionByName(judged.drop("__sid"))
