"""Language identification: sparse multinomial logistic regression on hashed TF-IDF character n-grams.

Document frequencies cover every learning document (one vector per task, added up in Spark). The weights are fitted by
follow-the-regularised-leader with an elastic-net penalty on a bounded, hash-chosen sample of labelled rows, and a
temperature is then fitted on rows the weights have not seen. Prediction is a map over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerframe.llm.common import table

BITS = 14
DIM = 1 << BITS
#: Labelled rows, about, that are taken of each language for fitting; and at most in all.
PER_LANG, MAX_ROWS = 500, 6000
EPOCHS = 4
#: FTRL: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.01
UNKNOWN = "und"


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the character 1- to 3-grams of a whole text, lower-cased."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    grams = [c * np.uint32(2654435761)]
    if len(c) > 1:
        grams.append(c[:-1] * np.uint32(2246822519) + c[1:] * np.uint32(3266489917))
    if len(c) > 2:
        grams.append(c[:-2] * np.uint32(668265263) + c[1:-1] * np.uint32(374761393) + c[2:] * np.uint32(3323815723))
    h = np.concatenate(grams)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822507)
    counts = np.bincount((h >> np.uint32(32 - BITS)).astype(np.intp), minlength=DIM)
    at = np.flatnonzero(counts)
    return at, counts[at]


def tf_idf(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / max(np.sqrt(np.dot(x, x)), 1e-12)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, text: str) -> np.ndarray:
        at, counts = ngram_counts(text)
        z = tf_idf(at, counts, self.idf) @ self.weights[at] / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (DIM x classes) by FTRL-proximal over rows of (buckets, values, class), in the order given."""
    z, n = np.zeros((DIM, classes)), np.zeros((DIM, classes))
    for _ in range(epochs):
        for at, x, y in rows:
            w = _weights(z[at], n[at])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    return _weights(z, n)


def fit_temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature, of a fixed grid from 1/32 to 8, with the least log loss; 1 without rows."""
    if not len(logits):
        return 1.0
    best = (np.inf, 1.0)
    for t in 2.0 ** np.arange(-5, 3.01, 0.125):
        s = logits / t
        s -= s.max(axis=1, keepdims=True)
        loss = np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), classes])
        best = min(best, (loss, t))
    return float(best[1])


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG, max_rows: int = MAX_ROWS) -> Model | None:
    """A model from docs' texts and non-null languages; None if there is no such row with letters.

    Document frequencies count every row; about per_lang rows of each language, max_rows at most in all, are fitted on, in an order
    that follows from ids, languages and texts alone, so weights don't change from run to run. Repeated rows count each time, null
    ids are one id like any other, very long texts are read whole.
    """
    text = F.col(text_col).cast("string")
    rows = docs.where(F.col(lang_col).isNotNull() & has_letters(text)).select(F.col(lang_col).cast("string").alias("lang"), text.alias("text"), (F.pmod(F.xxhash64(F.col(id_col), F.lit(6)), F.lit(1 << 40)) / float(1 << 40)).alias("u"))
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return None
    langs = sorted(per)
    per_lang = max(1, min(per_lang, max_rows // len(langs)))  # so that the bound leaves out no language

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for x in batch["text"]:
                total[ngram_counts(x)[0]] += 1
            n += len(batch)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(at, DIM), "n": np.append(total[at], n)})

    found = rows.select("text").mapInPandas(frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIM + 1)
    for r in found:
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1

    @F.pandas_udf("struct<at:binary,counts:binary>")
    def packed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            made = [ngram_counts(x) for x in batch]
            yield pd.DataFrame({"at": [a.astype(np.uint16).tobytes() for a, _ in made], "counts": [c.astype(np.float32).tobytes() for _, c in made]})

    share = F.create_map(*[x for k, n in per.items() for x in (F.lit(k), F.lit(per_lang / n))])
    some = rows.where(F.col("u") < F.element_at(share, F.col("lang"))).orderBy("u", "lang", F.sha2("text", 256)).limit(max_rows)
    sample = []
    for r in some.select("lang", packed("text").alias("f")).collect():
        at = np.frombuffer(r["f"]["at"], np.uint16).astype(np.intp)
        sample.append((at, tf_idf(at, np.frombuffer(r["f"]["counts"], np.float32), idf), langs.index(r["lang"])))
    held = sample[::5] if len(sample) >= 10 else []
    fitted = [x for k, x in enumerate(sample) if k % 5] if held else sample
    weights = fit_ftrl(fitted, len(langs))
    logits = np.array([x @ weights[at] for at, x, _ in held]).reshape(-1, len(langs))
    return Model(langs, idf, weights.astype(np.float64), fit_temperature(logits, np.array([y for *_, y in held], np.intp)))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, *keep): one row per row of docs; the language of the whole text and its calibrated probability.

    A null text, one without letters, and any text without a model have `und` and score 0. Equal texts have equal
    predictions; very long texts are read whole; an empty table gives an empty result; columns not named are not read.
    """
    text = F.col(text_col).cast("string")
    base = [F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep if c != "doc_id"]]
    if model is None:
        return docs.select(*base, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,score:double>")
    def best(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in texts:
            out = [(UNKNOWN, 0.0)] * len(batch)
            for k, x in enumerate(batch):
                if x is not None:
                    p = m.probabilities(x)
                    out[k] = m.langs[int(p.argmax())], float(p.max())
            yield pd.DataFrame(out, columns=["lang", "score"])

    rows = docs.select(*base, best(F.when(has_letters(text), text)).alias("p"))
    return rows.select(*[c for c in rows.columns if c != "p"], F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op6(spark, sf_dir: str) -> DataFrame:
    """predict over all documents by a model of those that are not held out; odd rows as there and in learn."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
