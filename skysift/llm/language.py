"""Problem 10: the language of documents and of their segments (Bayesian evidence fusion)."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skysift.operators.spread import spread
from skysift.session import materialize

#: Labelled documents that the text model is fitted on, at most about.
FIT_DOCUMENTS = 20_000
#: Rounds in which the sample's sentences are relabelled by the model of the round before.
ROUNDS = 3
#: A word says at most so much (log units) against a language.
WORD_LIMIT = 6.0
#: Pseudo-counts of the coarser level in the smoothed priors.
PRIOR_WEIGHT = 20.0
#: Pseudo-counts of "any language" in the prior that a document's other sentences give.
CONTEXT_WEIGHT = 0.5
#: Sentences that make a language count in a text of several.
SENTENCES = 2

# ISO 639-2 codes (bibliographic and terminological) of the ISO 639-1 codes.
ISO_THREE = {
    "eng": "en", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "spa": "es", "ita": "it", "por": "pt", "nld": "nl", "dut": "nl", "pol": "pl",
    "ces": "cs", "cze": "cs", "dan": "da", "ell": "el", "gre": "el", "est": "et", "fin": "fi", "hun": "hu", "lav": "lv", "lit": "lt", "nor": "no",
    "ron": "ro", "rum": "ro", "rus": "ru", "slk": "sk", "slo": "sk", "slv": "sl", "swe": "sv", "tur": "tr", "ukr": "uk", "zho": "zh", "chi": "zh", "jpn": "ja", "kor": "ko", "ara": "ar",
}
# English names of languages.
NAMES = {
    "english": "en", "french": "fr", "german": "de", "spanish": "es", "italian": "it", "portuguese": "pt", "dutch": "nl", "polish": "pl",
    "chinese": "zh", "japanese": "ja", "korean": "ko", "arabic": "ar", "russian": "ru", "ukrainian": "uk", "turkish": "tr", "swedish": "sv",
}
NO_LABEL = ("", "und", "unknown", "mul", "zxx", "none", "null")

_LOG = re.compile(r"^[^\n]*$", re.M)
_END = re.compile(r"[.!?…]+[\"'»”’)\]]*(?=\s|\x00|\Z)|[。！？｡।؟]+[\"'»”’)\]」』]*|\x00+|\Z")
_NATURAL = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
#: Scripts that put no blanks between words: Thai, Lao, Myanmar, Khmer, kana and Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_MARKUP = r"<[^<>]{1,300}?\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b"
_EDGE = ".,;:!?…。、，．！？｡।؟「」『』《》（）\"'()[]«»“”„‘’–—-•>*"
_FOLD = str.maketrans({"ł": "l", "ß": "ss", "ø": "o", "æ": "ae", "œ": "oe", "đ": "d", "’": "'"})


def canonical_label(label):
    """Two-letter code of a label column in any spelling, other three-letter codes as they are; null if it names no language."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]+)", 1))
    known = F.create_map(*(F.lit(x) for p in (ISO_THREE | NAMES).items() for x in p))
    return F.when(head.isin(*NO_LABEL), None).when(F.length(head) == 2, head).otherwise(F.coalesce(known[head], F.when(F.length(head) == 3, head)))


def fold(word: str) -> str:
    word = word.casefold().translate(_FOLD)
    if word.isascii():
        return word
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


_WORDS: dict[str, str | tuple[str, ...] | None] = {}


def _word_of(token: str) -> str | tuple[str, ...] | None:
    bare = token.strip(_EDGE)
    if bare and not bare.isascii():
        bare = "".join(c for c in bare if unicodedata.category(c)[0] != "M") if _UNSPACED.search(bare) else unicodedata.normalize("NFC", bare)
        if not _NATURAL.fullmatch(bare):
            bare = "".join(c for c in bare if unicodedata.category(c)[0] != "M")
    if not bare or not _NATURAL.fullmatch(bare):
        return None
    if len(bare) > 2 and _UNSPACED.search(bare):
        return tuple(fold(bare[k : k + 2]) for k in range(len(bare) - 1))
    return fold(bare)


def natural_words(tokens: list[str]) -> tuple[list[str], int]:
    """Folded words, and how many tokens they come from; tokens with digits, underscores or signs inside have no language.

    Tokens of scripts without blanks between words give their pairs of neighbouring characters.
    """
    out, n = [], 0
    for t in tokens:
        w = _WORDS.get(t, "")
        if w == "":
            w = _word_of(t)
            if len(_WORDS) < 200_000:
                _WORDS[t] = w
        if w:
            n += 1
            out.append(w) if w.__class__ is str else out.extend(w)
    return out, n


def _is_log(line: str) -> bool:
    tokens = line.split()
    if not tokens:
        return False
    plain = sum(1 for t in tokens if _NATURAL.fullmatch(t.strip(_EDGE)))
    signs = sum(1 for t in tokens if "=" in t or '":' in t or t[0] in "{[<")
    return plain == 0 or (signs and plain <= len(tokens) / 2)


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(begin, end, words) of the sentences of a text; lines of logs are cut out."""
    if not text:
        return []
    text = text.replace("\x00", " ")
    if "\n" in text:
        text = _LOG.sub(lambda m: "\x00" * len(m[0]) if _is_log(m[0]) else m[0], text).replace("\n", " ")
    out, begin = [], 0
    for m in _END.finditer(text):
        log = m[0][:1] == "\x00"
        end = m.start() if log else m.end()
        piece = text[begin:end]
        tokens = piece.split()
        w, n = natural_words(tokens)
        if len(w) >= 2 and 2 * n >= len(tokens):
            out.append((end - len(piece.lstrip()), end - len(piece) + len(piece.rstrip()), w))
        begin = m.end()
    if not out:
        # no sentence of two words: what words there are make one
        tokens = text.replace("\x00", " ").split()
        w, n = natural_words(tokens)
        if w and 2 * n >= len(tokens):
            bare = text.replace("\x00", " ")
            out.append((len(bare) - len(bare.lstrip()), len(bare.rstrip()), w))
    return out


class TextModel:
    """Word likelihoods by language; words not seen in fitting are judged by letter triples."""

    def __init__(self, counts: dict[str, dict[str, float]]) -> None:
        """counts: word -> language -> how often."""
        self.languages = sorted({x for c in counts.values() for x in c})
        at = {x: i for i, x in enumerate(self.languages)}
        k = len(self.languages)
        self.words = {}
        total = np.zeros(k)
        triples: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(k))
        rows = []
        for word, c in counts.items():
            v = np.zeros(k)
            for x, n in c.items():
                v[at[x]] += n
            rows.append((word, v))
            total += v
            for t in self._triples(word):
                triples[t] += np.sqrt(v)
        all_ = total.sum()
        for word, v in rows:
            if v.sum() >= 2:
                self.words[word] = self._log(v, total, v.sum() / all_, 300.0)
        sums = sum(triples.values()) if triples else np.zeros(k)
        self.triples = {t: self._log(v, sums, v.sum() / max(sums.sum(), 1e-9), 100.0) / 2 for t, v in triples.items()}
        self.cache: dict[str, np.ndarray] = {}

    @staticmethod
    def _triples(word: str) -> list[str]:
        w = f"^{word}$"
        return [w[i : i + 3] for i in range(len(w) - 2)]

    @staticmethod
    def _log(v: np.ndarray, total: np.ndarray, share: float, weight: float) -> np.ndarray:
        """Log ratio to the word's overall share, smoothed towards that share, bounded."""
        r = np.log((v + weight * share) / ((total + weight) * share))
        return np.maximum(r - r.max(), -WORD_LIMIT)

    def word(self, w: str) -> np.ndarray:
        v = self.words.get(w)
        if v is None:
            v = self.cache.get(w)
        if v is None:
            parts = [self.triples[t] for t in self._triples(w) if t in self.triples]
            v = np.maximum(np.sum(parts, axis=0), -WORD_LIMIT) if parts else np.zeros(len(self.languages))
            if len(self.cache) < 200_000:
                self.cache[w] = v
        return v

    def scores(self, sentences: list[list[str]]) -> np.ndarray:
        """Log likelihood of each language, up to a constant: a row for each list of words."""
        at: dict[str, int] = {}
        flat = np.fromiter((at.setdefault(w, len(at)) for s in sentences for w in s), np.int64)
        size = np.array([len(s) for s in sentences], np.int64)
        out = np.zeros((len(sentences), len(self.languages)))
        if len(flat):
            table = np.array([self.word(w) for w in at])
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
            some = size > 0
            out[some] = np.add.reduceat(table[flat], first[some], axis=0)
        return out


def in_context(score: np.ndarray) -> np.ndarray:
    """Scores of a document's sentences with a prior from its other sentences added.

    The prior is the smoothed share of each language in the rest of the document, where the
    two neighbours count most. It settles sentences that read alike in two languages.
    """
    n, k = score.shape
    if n < 2 or k < 2:
        return score
    p = np.exp(score - score.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    near = np.zeros_like(p)
    near[1:] += p[:-1]
    near[:-1] += p[1:]
    other = (p.sum(axis=0) - p) / (n - 1) + near
    return score + np.log((other + CONTEXT_WEIGHT / k) / (other.sum(axis=1, keepdims=True) + CONTEXT_WEIGHT))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sentences of labelled texts, as lists of words."""
    for b in batches:
        words = [[w for _, _, w in sentences(t)] for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.list_(pa.string())))], ["label", "sentences"])


def _by_text(found: list[list[list[str]]], scores: np.ndarray) -> list[np.ndarray]:
    """Scores of the sentences of each text, in context."""
    cut = np.cumsum([len(f) for f in found])[:-1] if found else []
    return [in_context(s) for s in np.split(scores, cut)]


def _word_counts(model: TextModel | None):
    """Partial (word, language, count) of sample sentences, labelled by document or by model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], int] = defaultdict(int)
        for b in batches:
            found = b.column(1).to_pylist()
            best = _by_text(found, model.scores([w for f in found for w in f])) if model is not None else None
            for i, label in enumerate(b.column(0).to_pylist()):
                for k, words in enumerate(found[i]):
                    x = label if best is None else model.languages[int(best[i][k].argmax())]
                    for a in words:
                        total[a, x] += 1
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in total]), pa.array([x for _, x in total]), pa.array(list(total.values()), pa.int64())], ["word", "language", "n"])

    return run


def fit(documents: DataFrame, most: int = FIT_DOCUMENTS) -> TextModel:
    """Fit the text model on a bounded sample of the labelled documents.

    The sample is taken by a hash of the document id, about ``most`` documents, whole texts.
    Wrong labels in it are overcome by relabelling its sentences with the model.
    """
    labelled = documents.select("doc_id", canonical_label(F.col("lang")).alias("label"), "text").where("label is not null and text is not null")
    n = labelled.count()
    share = min(1.0, most / max(n, 1))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("label", "text")
    sample = sample.repartition(max(1, min(64, int(n * share) // 500 + 1)))
    sample = materialize(sample.mapInArrow(_split, "label string, sentences array<array<string>>"), "language-sample")
    model = None
    for _ in range(ROUNDS):
        rows = sample.mapInArrow(_word_counts(model), "word string, language string, n long").groupBy("word", "language").agg(F.sum("n").alias("n"))
        counts: dict[str, dict[str, float]] = defaultdict(dict)
        for r in rows.toLocalIterator():
            counts[r["word"]][r["language"]] = r["n"]
        model = TextModel(counts)
    return model


def _segments(model):
    names = ["doc_id", "source", "label", "declared", "segment", "begin", "end", "words", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            row, number, begin, end, size = [], [], [], [], []
            found = [sentences(t) for t in b.column(4).to_pylist()]
            score = [x for s in _by_text(found, m.scores([w for f in found for _, _, w in f])) for x in s]
            for r, f in enumerate(found):
                for k, (a, z, w) in enumerate(f):
                    row.append(r), number.append(k), begin.append(a), end.append(z), size.append(len(w))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(take) for i in range(4)), *(pa.array(x, pa.int32()) for x in (number, begin, end, size)), pa.array(score, pa.list_(pa.float32()))], names)

    return run


def _log_prior(counts: list, coarser, languages: int):
    """Smoothed log shares: counts of this level, PRIOR_WEIGHT pseudo-counts of the coarser."""
    total = sum(counts[1:], counts[0])
    return [(c + PRIOR_WEIGHT * p) / (total + PRIOR_WEIGHT) for c, p in zip(counts, coarser)]


def segment_languages(documents: DataFrame, model: TextModel | None = None) -> DataFrame:
    """Language and confidence of every sentence with at least two natural words, or of a text that has no such sentence.

    Columns: doc_id, label (canonical), segment, begin, end (characters), words, lang,
    confidence. Text likelihoods are combined with the document's declared language, its label or
    else the ``lang`` of its markup (by how often that goes with each language), and with priors of its source: shares of languages by
    source, smoothed towards those by the source's address suffix, smoothed towards those of
    all documents. All counts come from grouped aggregation over all documents.
    """
    spark = documents.sparkSession
    model = model or fit(documents)
    langs = model.languages
    k = len(langs)
    label = canonical_label(F.col("lang"))
    declared = F.coalesce(label, canonical_label(F.regexp_extract("text", _MARKUP, 1)))
    plain = documents.select(F.col("doc_id").cast("long"), "source", label.alias("label"), declared.alias("declared"), "text").where("doc_id is not null and text is not null")
    empty = "doc_id long, label string, segment int, begin int, end int, words int, lang string, confidence double"
    if not k:
        return spark.createDataFrame([], empty)
    schema = "doc_id long, source string, label string, declared string, segment int, begin int, end int, words int, score array<float>"
    rows = materialize(spread(plain, "doc_id").mapInArrow(_segments(spark.sparkContext.broadcast(model)), schema), "segments")
    rows = rows.withColumn("source", F.coalesce("source", F.lit(""))).withColumn("suffix", F.regexp_replace("source", r"^[^-./@]*[-./@]", "")).withColumn("declared", F.coalesce("declared", F.lit("")))
    best = F.array_position("score", F.array_max("score")).cast("int")
    ones = [F.sum((best == i + 1).cast("double")).alias(f"n{i}") for i in range(k)]
    by = materialize(rows.groupBy("source", "suffix", "declared").agg(*ones), "language-counts")
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(k)]
    # by language and declared label: at most (languages + 1) rows
    table = {r["declared"]: [r[f"n{i}"] for i in range(k)] for r in by.where(F.col("declared").isin("", *langs)).groupBy("declared").agg(*sums).collect()}
    whole = by.agg(*sums).first()
    whole = [(whole[f"n{i}"] or 0.0) + 1.0 for i in range(k)]
    shares = [x / sum(whole) for x in whole]
    marks = {x: [math.log((c[i] + 0.5) / (whole[i] + 0.5 * (k + 1))) for i in range(k)] for x, c in table.items()}
    suffix = by.groupBy("suffix").agg(*sums).select("suffix", *(x.alias(f"s{i}") for i, x in enumerate(_log_prior([F.col(f"n{i}") for i in range(k)], [F.lit(x) for x in shares], k))))
    source = by.groupBy("source", "suffix").agg(*sums).join(suffix, "suffix")
    source = source.select("source", F.array(*(F.log(x) for x in _log_prior([F.col(f"n{i}") for i in range(k)], [F.col(f"s{i}") for i in range(k)], k))).alias("prior"))
    mark = F.coalesce(F.create_map(*(y for x, v in marks.items() for y in (F.lit(x), F.array(*map(F.lit, v)))))[F.col("declared")], F.array(*[F.lit(0.0)] * k)) if marks else F.array(*[F.lit(0.0)] * k)
    fused = rows.join(source, "source").withColumn("mark", mark)
    fused = fused.withColumn("post", F.expr("transform(score, (x, i) -> x + prior[i] + mark[i])")).withColumn("top", F.array_max("post"))
    known = F.array(*map(F.lit, langs))
    return fused.select(
        "doc_id", "label", "segment", "begin", "end", "words",
        F.element_at(known, F.array_position("post", F.col("top")).cast("int")).alias("lang"),
        (1 / F.expr("aggregate(post, 0D, (s, x) -> s + exp(x - top))")).alias("confidence"),
    )


def document_languages(segments: DataFrame) -> DataFrame:
    """Languages of each document, from its segments: doc_id, label, lang, sentences, of, confidence, counts.

    A language counts if at least SENTENCES sentences, or all, are written in it. A document in
    which none does has one row, of its foremost language, that does not count.
    """
    each = segments.groupBy("doc_id", "label", "lang").agg(F.count("*").alias("sentences"), F.sum("words").alias("words"), F.avg("confidence").alias("confidence"))
    rank = F.struct("sentences", "words", "lang")
    whole = each.groupBy("doc_id").agg(F.sum("sentences").alias("of"), F.max(F.when(F.col("sentences") >= SENTENCES, 1).otherwise(0)).alias("any"), F.max_by("lang", rank).alias("first"))
    counts = (F.col("sentences") >= SENTENCES) | (F.col("sentences") == F.col("of"))
    kept = each.join(whole, "doc_id").withColumn("counts", counts).where(F.col("counts") | ((F.col("any") == 0) & (F.col("lang") == F.col("first"))))
    return kept.select("doc_id", "label", "lang", "sentences", "words", "of", "confidence", "counts")


def corrected_languages(languages: DataFrame) -> DataFrame:
    """Rows that count, of documents whose label is missing or names another language, or that are mixed."""
    languages = languages.where("counts")
    many = languages.groupBy("doc_id").agg(F.count("*").alias("many"), F.max((F.col("lang") == F.col("label")).cast("int")).alias("right"))
    return languages.join(many, "doc_id").where((F.col("many") > 1) | (F.coalesce("right", F.lit(0)) == 0)).drop("many", "right", "counts")
