"""Language-model scores from an n-gram trie that is spread over the cluster.

The model is a bigram model with Dirichlet smoothing over unigrams, p(w|v) = (c(v,w) + m p1(w)) / (c(v) + m). Its n-grams are kept in Elias-Fano
tries (``elias_fano.Trie``): per context an exact count, a quantised backoff weight m / (c(v) + m) and a pointer to its successors, per successor
a quantised c(v,w) / (c(v) + m). The model grows with the corpus and is never in one place: a shard holds a range of context keys.

1. Documents are dealt into blocks of some megabytes. A block sends each shard the distinct contexts and successors it needs, with how often
   they occur in its training documents. A frequent word is one entry per block however often it occurs.
2. A shard adds up the counts, builds its trie, and answers every block by searching the contexts, then the successors within each.
3. Blocks meet the answers and score their documents.

Frequent contexts (more than one in a thousand tokens; there are at most a thousand) have too many successors for one shard. They are counted
beforehand and split by their successors' hash into as many contexts as their share asks for.

The unigram model of the trie's smoothing is (1 - e) c(w)/N + e/T: a share e of the mass is spread over an open vocabulary of T words.

Defined results: a null or empty text is its end token alone. Each input row gives one row. Rows with a null id are scored like others
and belong to the fold of the empty text. Without training documents all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.llm.elias_fano import SUCCESSOR_BITS, Trie, quantise, restore
from deltaloom.llm.text import mix, octets, words
from deltaloom.storage import cut_lineage

#: Keys of the end token and of the context before the first word; no word's key by chance of 2^-64.
END, BEGIN = np.uint64(0xE1D0000000000001), np.uint64(0xBE61000000000003)
#: Bytes of text in a block; a shard gets as many bytes of text's n-grams.
BLOCK = 12 << 20
#: Share of all tokens above which a context is split.
FREQUENT = 1e-3
#: Weight m of the unigram model; mass e and size T of the open vocabulary.
PRIOR, OPEN_MASS, OPEN_WORDS = 1000.0, 0.05, 1e7

_MASK = np.uint64((1 << SUCCESSOR_BITS) - 1)


def tokens(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token keys of all rows, one end token each; the key before each; and where rows begin."""
    hashes, lengths = [], []
    for part in words(array, plain=False):
        hashes.append(part.hashes)
        lengths.append(np.diff(part.bounds))
    lengths = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
    out = np.full(int(bounds[-1]), END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[bounds[1:] - 1] = False
    out[inner] = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[bounds[:-1]] = BEGIN
    return out, before, bounds


def _totals(rows: DataFrame) -> tuple[int, int, int]:
    """Bytes of text, training rows, and training tokens."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n = [np.diff(part.bounds) for part in words(batch, plain=False)]
            yield pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    count = F.arrow_udf(run, "long")(F.col("octets"))
    sums = rows.select(F.length("octets").alias("bytes"), F.col("train").cast("long").alias("train"), count.alias("n"))
    r = sums.agg(F.sum("bytes"), F.sum("train"), F.sum((F.col("n") + 1) * F.col("train"))).first()
    return r[0] or 0, r[1] or 0, r[2] or 0


def _counted(rows: DataFrame, choose) -> DataFrame:
    """Counts of those token keys in training rows that ``choose(distinct keys, counts)`` marks, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, _, _ = tokens(batch.column("octets"))
            keys, n = np.unique(found, return_counts=True)
            kept = choose(keys, n)
            yield pa.RecordBatch.from_pydict({"key": keys[kept].view(np.int64), "n": n[kept].astype(np.int64)})

    return rows.where("train").select("octets").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent_contexts(rows: DataFrame, n_train: int, n_tokens: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of frequent contexts, their exact counts, and into how many each is split.

    A word with more than a share of all tokens has more than that share in some batch, so the batches' frequent words are candidates;
    these (some thousand) are then counted exactly.
    """
    candidates = _counted(rows, lambda keys, n: n > FREQUENT * n.sum()).where(F.col("n") > FREQUENT * n_tokens / 4).select("key").collect()
    listed = np.sort(np.array([r["key"] for r in candidates], np.int64).view(np.uint64))
    exact = _counted(rows, lambda keys, n: np.isin(keys, listed)).where(F.col("n") > FREQUENT * n_tokens).collect()
    keys = np.array([r["key"] for r in exact], np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in exact], np.int64)
    keys, counts = np.concatenate([keys, [BEGIN]]), np.concatenate([counts, [n_train]])
    kept = keys != END  # never a context
    keys, counts = keys[kept], counts[kept]
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    return keys, counts, (1 + np.ceil(counts / max(1, n_tokens) * shards)).astype(np.uint64)


class Requests:
    """Distinct contexts (``keys``) and successors of one block, in the order in which they are asked for."""

    def __init__(self, found: np.ndarray, before: np.ndarray, frequent, shards: int):
        names, _, parts = frequent
        with np.errstate(over="ignore"):
            successor = mix(found) & _MASK
            at = np.searchsorted(names, before)
            at[at == len(names)] = 0
            split = names[at] == before
            context = before.copy()
            salt = successor[split] % parts[at[split]] + np.uint64(1)
            context[split] = mix(before[split] + salt * np.uint64(0xD1342543DE82EF95))
        asked = np.unique(context)
        self.keys = np.union1d(np.unique(found), asked)
        self.token = np.searchsorted(self.keys, found)  # of each token: its own key
        self.fixed = np.zeros(len(self.keys), np.int64)
        owner = np.searchsorted(self.keys, context)
        self.fixed[owner[split]] = frequent[1][at[split]]
        pairs, self.pair = np.unique((owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | successor, return_inverse=True)
        self.owners = (pairs >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)
        self.successors = pairs & _MASK
        shard = (self.keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
        edges = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
        self.slices = [(s, int(a), int(b), *np.searchsorted(self.owners, [a, b]).tolist()) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]


def _five(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


_REQUEST = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("keys", "counts", "fixed", "sizes", "successors", "pair_counts")]
)
_ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("distinct", pa.int64())] + [(c, pa.binary()) for c in ("counts", "backoff", "alpha")])
_SCORE = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("distinct", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.float64(): "double", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _joined(table: pa.Table, column: str) -> pa.Array:
    return pa.concat_arrays(table.column(column).chunks) if table.num_rows else pa.array([], table.schema.field(column).type)


def _ask(frequent, shards: int):
    shared = frequent

    def run(table: pa.Table) -> pa.Table:
        known = shared.value
        found, before, bounds = tokens(_joined(table, "octets"))
        r = Requests(found, before, known, shards)
        train = np.repeat(_joined(table, "train").to_numpy(zero_copy_only=False), np.diff(bounds))
        counts = np.bincount(r.token[train], minlength=len(r.keys)).astype(np.uint32)
        pair_counts = np.bincount(r.pair[train], minlength=len(r.owners)).astype(np.uint32)
        sizes = np.bincount(r.owners, minlength=len(r.keys)).astype(np.uint32)
        block = table.column("block")[0].as_py()
        rows = [
            (s, block, r.keys[a:b].tobytes(), counts[a:b].tobytes(), r.fixed[a:b].tobytes(), sizes[a:b].tobytes(), _five(r.successors[c:d]), pair_counts[c:d].tobytes())
            for s, a, b, c, d in r.slices
        ]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _REQUEST.types, strict=True)], schema=_REQUEST)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Build one shard's trie from all blocks' counts and answer each block by searching it."""
    column = {c: [np.frombuffer(x.as_buffer(), t) for x in _joined(table, c)] for c, t in (("keys", np.uint64), ("counts", np.uint32), ("fixed", np.int64), ("sizes", np.uint32), ("pair_counts", np.uint32))}
    successors = [_from_five(x.as_buffer()) for x in _joined(table, "successors")]
    keys, where = np.unique(np.concatenate(column["keys"]), return_inverse=True)
    counts = np.bincount(where, np.concatenate(column["counts"]), len(keys)).astype(np.int64)
    fixed = np.zeros(len(keys), np.int64)
    np.maximum.at(fixed, where, np.concatenate(column["fixed"]))
    owner = np.repeat(where, np.concatenate(column["sizes"]))
    pairs, at = np.unique((owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | np.concatenate(successors), return_inverse=True)
    pair_counts = np.bincount(at, np.concatenate(column["pair_counts"]), len(pairs)).astype(np.int64)
    del at, owner
    trained = pair_counts > 0
    seen = (counts > 0) | (fixed > 0)
    rank = np.cumsum(seen) - 1
    pairs, pair_counts = pairs[trained], pair_counts[trained]
    trie = Trie(
        keys[seen], counts[seen], np.maximum(counts, fixed)[seen], rank[(pairs >> np.uint64(SUCCESSOR_BITS)).astype(np.int64)], pairs & _MASK, pair_counts, PRIOR
    )
    distinct = int((counts > 0).sum())
    full = int(quantise(np.array([1.0]))[0])
    out = []
    for i, (block, mine, sizes) in enumerate(zip(table.column("block").to_pylist(), column["keys"], column["sizes"], strict=True)):
        position = trie.find(mine)
        known = np.maximum(position, 0)
        times = np.where(position >= 0, trie.counts[known] if len(trie.counts) else 0, 0)
        backoff = np.where(position >= 0, trie.backoff[known] if len(trie.backoff) else full, full).astype(np.uint8)
        alpha = trie.probabilities(np.repeat(position, sizes), successors[i])
        out.append((block, table.column("shard")[0].as_py(), distinct if i == 0 else 0, times.astype(np.int64).tobytes(), backoff.tobytes(), alpha.tobytes()))
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _ANSWER.types, strict=True)], schema=_ANSWER)


def _score(frequent, shards: int, n_tokens: int):
    shared = frequent

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        found, before, bounds = tokens(_joined(docs, "octets"))
        r = Requests(found, before, shared.value, shards)
        counts, backoff, alpha = np.zeros(len(r.keys), np.int64), np.zeros(len(r.keys), np.uint8), np.zeros(len(r.owners), np.uint8)
        by_shard = {s: k for k, s in enumerate(answers.column("shard").to_pylist())}
        columns = [_joined(answers, c) for c in ("counts", "backoff", "alpha")]
        for s, a, b, c, d in r.slices:
            got = [x[by_shard[s]].as_buffer() for x in columns]
            counts[a:b], backoff[a:b], alpha[c:d] = np.frombuffer(got[0], np.int64), np.frombuffer(got[1], np.uint8), np.frombuffer(got[2], np.uint8)
        own = counts[r.token]
        unigram = (1 - OPEN_MASS) * own / max(1, n_tokens) + OPEN_MASS / OPEN_WORDS
        p = restore(alpha)[r.pair] + restore(backoff)[r.owners[r.pair]] * unigram
        per = lambda x: np.add.reduceat(x, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)  # noqa: E731  every row has a token
        n = docs.num_rows
        out = [
            _joined(docs, "id"), pc.invert(_joined(docs, "train")), pa.array(np.diff(bounds)), pa.array(per((own > 0).astype(np.int64))),
            pa.array(per(np.log10(own + 1.0))), pa.array(per(np.log10(p))), pa.nulls(n, pa.int64()),
        ]
        scored = pa.Table.from_arrays(out, schema=_SCORE)
        total = sum(answers.column("distinct").to_pylist())
        tail = pa.Table.from_arrays([pa.nulls(1, t) for t in _SCORE.types[:-1]] + [pa.array([total], pa.int64())], schema=_SCORE)
        return pa.concat_tables([scored, tail])

    return run


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Frame (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for all rows; ``train`` marks those the model learns from.

    ``base_score`` is exact add-one unigram scoring; ``score`` the trie's log10 probability.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), octets(F.col(text)).alias("octets"))
    size, n_train, n_tokens = _totals(rows)
    blocks = max(1, -(-size // block))
    frequent = sc.broadcast(frequent_contexts(rows, n_train, n_tokens, blocks))  # a thousand words
    dealt = rows.select(F.pmod(F.xxhash64("id", "octets"), F.lit(blocks)).alias("block"), "id", "train", "octets")
    asked = dealt.groupBy("block").applyInArrow(_ask(frequent, blocks), _ddl(_REQUEST))
    answers = asked.groupBy("shard").applyInArrow(_answer, _ddl(_ANSWER))
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(frequent, blocks, n_tokens), _ddl(_SCORE))
    scored = cut_lineage(scored, "scores")
    distinct = scored.agg(F.sum("distinct")).first()[0] or 0
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(n_tokens + distinct + 1)))
    return scored.where("n_tokens is not null").select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )
