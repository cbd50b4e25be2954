"""Quality classifier: an interpolated modified Kneser-Ney model of characters, per language.

The model has trigrams of characters and is trained on every trusted document. The documents are
dealt once into shards of bounded size. A shard gives one row per n-gram it holds; these rows are
joined with the model's counts, turned into probabilities and sent back to their shards,
where each document's perplexity is read off. So the model is never in one place, and the
text moves once. A document
is rejected if its log perplexity exceeds a limit of its language, which is set by two
quantiles over that language's trusted documents.

Text that a model was trained on is likelier to it than any other, so the limits come from
held-out perplexities: trusted documents are dealt into ``FOLDS`` folds by their text, and each is
scored by a model of the other folds as well. A language with fewer than ``MIN_TRUSTED`` different
trusted texts so scored has no limit, and all its documents are kept.

A language has ``MODELS`` models: number 0 is trained on all folds, number k + 1 on all but fold k. They
are counted, joined and sent back side by side, as arrays with one place for each model, so that an
n-gram of a shard is one row however many models have to score it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.llm.common import slices, stored

#: Bytes of text that a shard holds on average.
SHARD_BYTES = 16 << 20
#: Characters whose n-grams are held at once.
AT_ONCE = 1 << 20
#: As many ids of trusted documents (16 MB) may be broadcast; more of them are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: The limit is the median plus ``SPREAD`` times the way from it to the upper quantile.
UPPER, SPREAD = 0.95, 3.0
#: Folds of trusted documents (one digit), and how many different held-out texts set a limit.
FOLDS, MIN_TRUSTED = 5, 10
MODELS = FOLDS + 1
#: Two starts of text precede each document; a code point has 21 bits.
START, BITS = 0, 21


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all texts after another, packed, and where each text's begin and end."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
              for t in texts]
    ends = np.cumsum([0, *map(len, points)])
    if not ends[-1]:
        return np.zeros(0, np.int64), ends
    c = np.concatenate(points)
    b = np.concatenate([[START], c[:-1]])
    a = np.concatenate([[START], b[:-1]])
    first = ends[:-1][np.diff(ends) > 0]
    a[first], b[first] = START, START
    second = first + 1
    second = second[second < len(c)]
    inside = second[~np.isin(second, first)]
    a[inside] = START
    return a << (2 * BITS) | b << BITS | c, ends


def _columns(table: pa.Table) -> tuple[list, ...]:
    return tuple(table.column(c).to_pylist() for c in ("doc_id", "text", "lang", "fold"))


def _parts(texts: list[str], chosen: list[int]) -> Iterator[list[int]]:
    """Runs of the chosen texts of about ``AT_ONCE`` characters, whole texts only."""
    part, size = [], 0
    for i in chosen:
        part.append(i)
        size += len(texts[i])
        if size >= AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _add(sums: dict, key: tuple, gram: np.ndarray, n: np.ndarray) -> None:
    """Adds counts of n-grams to those of a key."""
    if key in sums:
        gram, at = np.unique(np.concatenate([sums[key][0], gram]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([sums[key][1], n]), minlength=len(gram)).astype(np.int64)
    sums[key] = gram, n


def _by_key(texts: list[str], keys: list[tuple | None], sums: dict) -> None:
    for key in set(keys) - {None}:
        for part in _parts(texts, [i for i, x in enumerate(keys) if x == key]):
            found, _ = grams([texts[i] for i in part])
            _add(sums, key, *np.unique(found, return_counts=True))


def _of_fold(folds: list[int | None], langs: list[str]) -> list[tuple | None]:
    """For trusted documents the model without their fold, and their language."""
    return [None if fold is None else (fold + 1, lang) for fold, lang in zip(folds, langs)]


def _count(batches):
    """Per task: the n-grams of trusted text of each language and fold with their counts."""
    sums: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for batch in slices(batches):
        texts, langs, folds = (batch.column(i).to_pylist() for i in range(3))
        _by_key(texts, list(zip(folds, langs)), sums)
    for (fold, lang), (gram, n) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), fold, np.int32)),
             pa.array(gram), pa.array(n, pa.int64())], ["lang", "fold", "gram", "n"])


def _held(table: pa.Table) -> pa.Table:
    """Per shard: its distinct n-grams, and as bits of ``models`` which models have to score each."""
    _, texts, langs, folds = _columns(table)
    shard, sums = table.column("shard")[0].as_py(), {}
    _by_key(texts, [(0, lang) for lang in langs], sums)
    _by_key(texts, _of_fold(folds, langs), sums)
    out = []
    for lang in set(langs):
        gram = sums[0, lang][0]
        bits = np.ones(len(gram), np.int32)
        for k in range(1, MODELS):
            if (k, lang) in sums:
                bits[np.searchsorted(gram, sums[k, lang][0])] |= 1 << k
        out.append(pa.table({"shard": pa.array(np.full(len(gram), shard, np.int64)),
                             "lang": pa.array([lang] * len(gram), pa.string()), "gram": pa.array(gram),
                             "models": pa.array(bits)}))
    return pa.concat_tables(out)


def _means(texts: list[str], models: list[tuple | None], scored: pa.Table) -> list[float | None]:
    """The mean of minus log probability over each text's characters, by the text's model and language."""
    of_row = np.array(scored.column("lang").to_pylist(), object)
    gram, logp = scored.column("gram").to_numpy(), scored.column("logp").combine_chunks()
    logp = logp.flatten().to_numpy(zero_copy_only=False).reshape(-1, MODELS)
    means: list[float | None] = [None] * len(texts)
    for model in set(models) - {None}:
        at = np.flatnonzero(of_row == model[1])
        order = at[np.argsort(gram[at], kind="stable")]
        known, value = gram[order], logp[order, model[0]].astype(np.float64)
        if np.isnan(value).all():  # no such language, or all its trusted text is in the fold left out
            continue
        for mine in _parts(texts, [i for i, x in enumerate(models) if x == model]):
            found, ends = grams([texts[i] for i in mine])
            sums = np.concatenate([[0.0], np.cumsum(value[np.searchsorted(known, found)])])
            for i, a, b in zip(mine, ends[:-1].tolist(), ends[1:].tolist()):
                if b > a:
                    means[i] = -float(sums[b] - sums[a]) / (b - a)
    return means


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per shard: each document's log perplexity, and its held-out one if it is trusted."""
    ids, texts, langs, folds = _columns(left)
    means = _means(texts, [(0, lang) for lang in langs], right)
    held_out = _means(texts, _of_fold(folds, langs), right)
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()),
                     "log_perplexity": pa.array(means, pa.float64()),
                     "held_out": pa.array(held_out, pa.float64())})


def _each(of: Callable[[int], Column]) -> Column:
    """An array with a place for each model."""
    return F.array(*map(of, range(MODELS)))


def _continued(counts: DataFrame, on: list[str]) -> DataFrame:
    """In how many contexts the last parts ``on`` of n-grams occur."""
    return counts.groupBy("lang", *on).agg(
        _each(lambda m: F.sum((F.col("n")[m] > 0).cast("long"))).alias("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d``: for each model the discounts of counts 1, 2 and more."""
    found = counts.groupBy("lang").agg(*[
        F.sum((F.col("n")[m] == k).cast("double")).alias(f"n{k}_{m}")
        for k in (1, 2, 3, 4) for m in range(MODELS)])

    def d(k: int, m: int) -> Column:
        n = {j: F.col(f"n{j}_{m}") for j in (1, 2, 3, 4)}
        y = n[1] / F.greatest(n[1] + 2 * n[2], F.lit(1.0))
        raw = k - (k + 1) * y * n[k + 1] / F.greatest(n[k], F.lit(1.0))
        return F.greatest(F.lit(0.05), F.least(F.lit(float(k)), raw))

    return found.select("lang", _each(lambda m: F.array(*[d(k, m) for k in (1, 2, 3)])).alias("d"))


def _shares(counts: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """What an order gives: ``kept`` of each n-gram, the share of its discounted count in its context
    ``on``, and ``back`` of each context, the share that goes to the order below. ``back`` is null where
    a model has not seen the context."""
    n, d = F.col("n"), F.col("d")
    counts = counts.join(_discounts(counts), "lang")

    def freed(m: int) -> Column:
        return F.sum(F.when(n[m] == 0, 0.0).when(n[m] == 1, d[m][0]).when(n[m] == 2, d[m][1])
                     .otherwise(d[m][2]))

    contexts = counts.groupBy("lang", *on).agg(
        _each(lambda m: F.sum(n[m])).alias("total"), _each(freed).alias("freed"))
    total = F.col("total")
    backs = contexts.select("lang", *on, _each(
        lambda m: F.when(total[m] > 0, F.col("freed")[m] / total[m])).alias("back"))
    kept = counts.join(contexts, ["lang", *on]).withColumn("kept", _each(lambda m: F.when(
        n[m] > 0, (n[m] - F.when(n[m] == 1, d[m][0]).when(n[m] == 2, d[m][1]).otherwise(d[m][2])) / total[m])
        .otherwise(0.0))).drop("n", "d", "total", "freed")
    return kept, backs


def probabilities(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(shard, lang, gram, models)`` with ``logp``, by each model of ``counts(lang, gram, n)`` among
    the bits of ``models``; null for other models and those that do not know the language, no rows for
    a language that none knows.

    Orders below the highest count in how many contexts an n-gram occurs. An unseen context
    gives the probability of the next lower order.
    """
    mask = (1 << BITS) - 1
    parts = {"a": F.shiftright("gram", 2 * BITS), "b": F.shiftright("gram", BITS).bitwiseAND(F.lit(mask)),
             "c": F.col("gram").bitwiseAND(F.lit(mask))}
    three = counts.withColumns(parts)
    two = stored(_continued(three, ["b", "c"]), "pairs")
    one = stored(_continued(two, ["c"]), "singles")
    kept_3, back_3 = _shares(three, ["a", "b"])
    kept_2, back_2 = _shares(two, ["b"])
    kept_1, back_1 = _shares(one, [])
    sizes = one.groupBy("lang").agg(
        _each(lambda m: F.sum((F.col("n")[m] > 0).cast("long")) + 1).alias("size"))
    unseen = stored(sizes.join(back_1, "lang").select("lang", _each(
        lambda m: F.col("back")[m] / F.col("size")[m]).alias("unseen")), "languages")
    # Stored, the sizes of the tables are known: small ones are broadcast, others shuffled.
    # Trigrams come first, while the rows that may have to be shuffled for them are narrow.
    rows = (wanted
            .join(stored(kept_3.select("lang", "gram", F.col("kept").alias("kept_3")), "trigrams"),
                  ["lang", "gram"], "left").withColumns(parts)
            .join(stored(back_3.withColumnRenamed("back", "back_3"), "contexts"), ["lang", "a", "b"], "left")
            .join(stored(kept_2.withColumnRenamed("kept", "kept_2"), "bigrams"), ["lang", "b", "c"], "left")
            .join(stored(back_2.withColumnRenamed("back", "back_2"), "contexts"), ["lang", "b"], "left")
            .join(stored(kept_1.withColumnRenamed("kept", "kept_1"), "unigrams"), ["lang", "c"], "left")
            .join(unseen, "lang"))

    def logp(m: int) -> Column:
        p = F.coalesce(F.col("kept_1")[m], F.lit(0.0)) + F.col("unseen")[m]
        for k in (2, 3):
            back = F.col(f"back_{k}")[m]
            p = F.when(back.isNull(), p).otherwise(F.coalesce(F.col(f"kept_{k}")[m], F.lit(0.0)) + back * p)
        return F.when(F.col("models").bitwiseAND(F.lit(1 << m)) != 0, F.log(p))

    return rows.select("shard", "lang", "gram", _each(logp).alias("logp"))


def with_folds(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with the ``fold`` of trusted documents, null for others; equal texts have one fold. A
    text is not shuffled if the trusted ids are few."""
    good = trusted.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("good")).distinct()
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    return docs.join(good, "doc_id", "left").withColumn("fold", F.when(F.col("good"), fold)).drop("good")


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, gram, n`` over the rows that have a fold; ``n`` has a place for each model."""
    folds = rows.where("fold IS NOT NULL").select("text", "lang", "fold")
    found = folds.mapInArrow(_count, "lang string, fold int, gram long, n long")
    return found.groupBy("lang", "gram").agg(_each(lambda m: F.sum(
        F.when(F.col("fold") != m - 1, F.col("n")).otherwise(F.lit(0)))).alias("n"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``doc_id, lang, log_perplexity, held_out`` of each row; null without text or without a model,
    ``held_out`` also for documents that are not trusted."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit("")).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = with_folds(rows, trusted)
    counts = stored(gram_counts(rows), "gram-counts")
    shards = max(8, size // SHARD_BYTES)
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    rows = rows.withColumn("shard", F.pmod(key, F.lit(shards)).cast("long"))
    held = rows.groupBy("shard").applyInArrow(_held, "shard long, lang string, gram long, models int")
    scored = probabilities(counts, held)
    return rows.groupBy("shard").cogroup(scored.groupBy("shard")).applyInArrow(
        _score, "doc_id long, lang string, log_perplexity double, held_out double")


def classify(docs: DataFrame, labels: DataFrame, upper: float = UPPER,
             spread: float = SPREAD) -> DataFrame:
    """``doc_id, lang, log_perplexity, max_log_perplexity, rejected`` of each row of ``docs``.

    ``docs`` has ``doc_id, text, lang``; trusted are those that ``labels`` gives quality 1 and
    not toxic 1 (a label that is null is no trust; repeated labels do no harm). A null language is the
    language ''. A document without text, or in a language without trusted text, has
    a null perplexity or limit and is not rejected. A language with fewer than ``MIN_TRUSTED`` different
    held-out texts (below that their quantiles say little of other text) has a null limit, so that all
    its documents are kept. Other columns are not read.
    """
    trusted = labels.where("quality = 1 AND coalesce(toxic, 0) <> 1")
    scores = stored(perplexities(docs, trusted), "perplexities")
    # counted in steps of 0.001, so that a language's quantiles need few rows however many documents
    steps = scores.where("held_out IS NOT NULL").groupBy("lang", "held_out").agg(
        F.count(F.lit(1)).alias("n")).groupBy("lang", F.round("held_out", 3).alias("step")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    limits = steps.groupBy("lang").agg(
        F.sum("texts").alias("texts"), F.expr("percentile(step, 0.5, n)").alias("middle"),
        F.expr(f"percentile(step, {float(upper)}, n)").alias("high"))
    limits = limits.where(F.col("texts") >= MIN_TRUSTED).select(
        "lang", (F.col("middle") + spread * (F.col("high") - F.col("middle"))).alias("max_log_perplexity"))
    return scores.join(limits, "lang", "left").select(
        "doc_id", "lang", "log_perplexity", "max_log_perplexity",
        F.coalesce(F.col("log_perplexity") > F.col("max_log_perplexity"), F.lit(False))
        .alias("rejected"))
