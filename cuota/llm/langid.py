"""Language of a text by the nearest of several centroids per language."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuota.llm.common import release, ship, stored, without

# About this many labelled texts per language (chosen by a hash of the id) fit the model. Prediction covers every text.
SAMPLE_PER_LANG = 500
# More label values than this are no languages and are refused: the centroids must fit into every worker.
MAX_LANGS = 256
CENTROIDS = 4
DIMENSIONS = 16384
# A text is rejected if its cosine to the nearest centroid is below this share of a low quantile of the cosines that the
# language's labelled texts of about the same number of n-grams have to centroids fitted without them. A length class
# with fewer than FLOOR_TEXTS texts is filled with longer ones, thinned to such a length.
FLOOR_SHARE = 0.25
FLOOR_QUANTILE = 0.05
FLOOR_TEXTS = 20
# Upper ends of the classes of text length, in n-grams, with a floor each.
LENGTHS = (8, 32, 128, 512)
UNKNOWN = "und"

_ADDED = ("lang_pred", "score", "rejected")
_SLICE = 1 << 22
_LETTER = regex.compile(r"\p{L}")
# Bytes as they enter n-grams: ASCII characters that are no letters become spaces, all others stay.
_FOLD = np.array([b if b > 127 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def gram_counts(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of a whole text's byte trigrams, lower-cased, hashed to `dimensions` places. Trigrams with a space in the
    middle say nothing and are left out. Long texts are counted in slices that overlap by two bytes."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    total = np.zeros(dimensions, np.int64)
    for start in range(0, max(len(data) - 2, 0), _SLICE):
        part = _FOLD[data[start:start + _SLICE + 2]]
        grams = (part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:])[part[1:-1] != 32]
        places = (grams * np.uint32(2654435761)) >> np.uint32(32 - int(dimensions).bit_length() + 1)
        total += np.bincount(places, minlength=dimensions)
    return total


@dataclass
class LanguageModel:
    """Unit centroids (rows), the language of each, floors per language and length class, and the weights of places."""

    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        counts = gram_counts(text, len(self.idf))
        places = np.flatnonzero(counts)
        weighed = counts[places] * self.idf[places]
        near = self.centroids[:, places] @ weighed / max(float(np.sqrt(weighed @ weighed)), 1e-30)
        best = int(near.argmax())
        score = float(min(max(near[best], 0.0), 1.0))
        own = self.owner[best]
        return self.languages[own], score, score < self.floors[own, length_class(counts.sum())]


def length_class(grams: int) -> int:
    return int(np.searchsorted(LENGTHS, grams))


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


def cluster(vectors: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit centroids of unit vectors. Begins with the first vector and those farthest from the chosen
    ones, so that it needs no random numbers."""
    chosen = [0]
    near = vectors @ vectors[0]
    while len(chosen) < min(count, len(vectors)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        means = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else centroids[i]
                          for i in range(len(centroids))])
        centroids = _unit(means)
    return centroids


def _thinned(counts: np.ndarray, grams: int, random: np.random.Generator) -> np.ndarray:
    """`grams` of the n-grams that a row counts, drawn without putting back."""
    places = np.repeat(np.flatnonzero(counts), counts[counts > 0].astype(np.int64))
    return np.bincount(random.choice(places, grams, replace=False), minlength=len(counts)).astype(counts.dtype)


def _floors(counts: np.ndarray, idf: np.ndarray, centroids: int) -> list[float]:
    """Per length class, the cosine below which a text is too far from every centroid.

    Each half of the texts is measured against centroids of the other half. A class that is sparse, with no longer texts
    to thin, takes the floor of the class below it; a single text has nothing to be measured against, and no floor.
    """
    if len(counts) < 2:
        return [0.0] * (len(LENGTHS) + 1)
    random, halves = np.random.default_rng(0), np.arange(len(counts)) % 2
    centres = [cluster(_unit(counts[halves != h] * idf), centroids) for h in range(2)]
    grams, floors = counts.sum(axis=1), []
    low = [1, *(n + 1 for n in LENGTHS)]
    for c, least in enumerate(low):
        own = np.flatnonzero(np.searchsorted(LENGTHS, grams) == c)
        rows, sides = [counts[i] for i in own], halves[own].tolist()
        longer = np.flatnonzero(grams > LENGTHS[c]) if c < len(LENGTHS) else own[:0]
        if len(own) < FLOOR_TEXTS:
            for i in random.permutation(longer)[:10 * FLOOR_TEXTS]:
                rows.append(_thinned(counts[i], int(random.integers(least, LENGTHS[c] + 1)), random))
                sides.append(halves[i])
        if not rows or len(rows) < FLOOR_TEXTS and floors and not len(longer):
            floors.append(floors[-1] if floors else 0.0)
            continue
        near = [float((centres[h] @ v).max()) for v, h in zip(_unit(np.stack(rows) * idf), sides)]
        floors.append(FLOOR_SHARE * float(np.quantile(near, FLOOR_QUANTILE)))
    return floors


def fit_languages(df: DataFrame, *, text: str = "text", lang: str = "lang", id: str = "doc_id",
                  usable: Column | None = None, sample_per_lang: int = SAMPLE_PER_LANG, centroids: int = CENTROIDS,
                  dimensions: int = DIMENSIONS) -> LanguageModel:
    """Model of the languages that the labelled rows name.

    Rows with a label, for which `usable` holds, are sampled by a hash of the id, about `sample_per_lang` a language.
    Executors count n-grams and cluster each language; what reaches the driver is a weight per place and `centroids`
    vectors per language. Without labelled rows the model has no language, and all texts are unknown.
    """
    ship(df.sparkSession)
    wanted = F.col(lang).isNotNull() & (F.lit(True) if usable is None else F.coalesce(usable, F.lit(False)))
    sizes = df.where(wanted).groupBy(F.col(lang).alias("lang")).count().limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} values of {lang}")
    empty = LanguageModel([], np.zeros(0, np.int64), np.zeros((0, dimensions), np.float32), np.zeros((0, 1)),
                          np.ones(dimensions, np.float32))
    if not sizes:
        return empty
    share = F.element_at(F.create_map(*[F.lit(x) for row in sizes for x in (
        row["lang"], min(1.0, sample_per_lang / row["count"]))]), F.col(lang))
    chance = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id).cast("string")), F.lit(1_000_000)) / 1_000_000
    chosen = df.where(wanted & (chance < share) & F.col(text).rlike(r"\p{L}"))

    @F.arrow_udf("struct<places:array<int>,counts:array<float>>")
    def features(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts.to_pylist():
            counts = gram_counts(value, dimensions)
            places = np.flatnonzero(counts)
            out.append({"places": places.tolist(), "counts": counts[places].tolist()})
        release()
        return pa.array(out, pa.struct([("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.float32()))]))

    sample = stored(chosen.select(F.col(lang).alias("lang"), features(F.col(text)).alias("f")).select("lang", "f.*"),
                    "language-sample")
    total = sample.count()
    if not total:
        return empty
    holding = sample.select(F.explode("places").alias("place")).groupBy("place").count().toArrow()
    found = np.zeros(dimensions)
    found[holding["place"].to_numpy()] = holding["count"].to_numpy()
    idf = (np.log((1 + total) / (1 + found)) + 1).astype(np.float32)

    def fit(rows):
        counts = np.zeros((len(rows), dimensions), np.float32)
        for i, (places, values) in enumerate(zip(rows["places"], rows["counts"])):
            counts[i, places] = values
        vectors = _unit(counts * idf)
        centres = cluster(vectors, centroids)
        floors = _floors(counts, idf, centroids)
        del counts, vectors
        release()
        return rows.head(1)[["lang"]].merge(_frame(centres, floors), how="cross")

    def _frame(centres, floors):
        import pandas as pd

        return pd.DataFrame({"centroid": [c.astype(np.float32).tolist() for c in centres],
                             "floors": [floors] * len(centres)})

    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, centroid array<float>, floors array<double>")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], r["centroid"]))
    names = sorted({r["lang"] for r in rows})
    floors = {r["lang"]: r["floors"] for r in rows}
    return LanguageModel(names, np.array([names.index(r["lang"]) for r in rows]),
                         np.array([r["centroid"] for r in rows], np.float32), np.array([floors[n] for n in names]), idf)


def identify_languages(df: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """Every row of `df` with `lang_pred`, `score` (cosine to the nearest centroid, 0 to 1) and `rejected`.

    Only the text decides. A text that is null or has no letter is `und`, with score 0, and rejected; any other gets the
    language of the nearest centroid, and is rejected if even that is farther away than nearly all of the
    language's labelled texts of such a length are from centroids fitted without them. Ties go to the language first in order. Each row gives one row, repeated ones too; an empty
    table gives an empty result. Columns of `df` named like the added ones are replaced.
    """
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        own = sent.value
        found = [own.predict(t) for t in texts.to_pylist()]
        kinds = (pa.string(), pa.float64(), pa.bool_())
        release()
        return pa.StructArray.from_arrays([pa.array([bool(f[i]) if i == 2 else f[i] for f in found], kinds[i])
                                           for i in range(3)], list(_ADDED))

    rest = without(df, *_ADDED)
    kept = [F.col(f"`{c}`") for c in rest.columns]
    return rest.withColumn("_language", predict(F.col(text))).select(*kept, *[f"_language.{c}" for c in _ADDED])


def held_out(id: str = "doc_id") -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
