"""Language identification by compression (operator 1).

Every language has a raw-content dictionary: text of that language, from a bounded sample
of labelled documents. A text is compressed with each dictionary; the one that makes it
smallest names the language. A text whose two best sizes are too close is rejected: the
best guess is still given, but ``rejected`` is true.

Texts are lower-cased and everything but letters becomes one space, for dictionaries and
texts alike. A long text is compressed in parts, since within one frame the text itself
would replace the dictionary; all parts count.

Defined results: a text that is null or has no letter is ``und`` with score 0. If no
labelled text was given, every text is ``und``. Of equal sizes the language with more
labelled documents wins, then the first by name. Repeated rows and copies count once each;
rows with a null id are never learned from. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.common import arrow_map, as_texts

UNKNOWN = "und"
# Bounds of the labelled sample: documents per language, characters of each, and how many of
# them are read to find as many that no other sampled document shares.
SAMPLED_DOCUMENTS = 64
SAMPLED_CHARS = 2_000
READ_CHARS = 2 * SAMPLED_CHARS
LEVEL = 9
PART_BYTES = 2_048
# Rejected if the second best is less than this share larger than the best, in sizes after compression.
NARROW_MARGIN = 0.01

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def plain_letters(text: str) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, most documents first."""

    dictionaries: dict[str, bytes]


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> LanguageModel:
    """Dictionaries from a sample: per language the least of the hashed ids in each of a fixed number of slots."""
    rows = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("hash")
    ).where(F.col("lang").isNotNull() & F.col(id_col).isNotNull() & F.col("text").rlike(r"\p{L}"))
    slots = (
        rows.groupBy("lang", F.pmod("hash", F.lit(SAMPLED_DOCUMENTS)).alias("slot"))
        .agg(F.min("hash").alias("hash"), F.count(F.lit(1)).alias("n"))
        .collect()  # at most SAMPLED_DOCUMENTS rows per language
    )
    sizes: dict[str, int] = {}
    for row in slots:
        sizes[row["lang"]] = sizes.get(row["lang"], 0) + row["n"]
    sample = (
        rows.where(F.col("hash").isin([row["hash"] for row in slots]))
        .groupBy("lang", "hash")
        .agg(F.min(F.substring("text", 1, READ_CHARS)).alias("text"))
        .collect()  # an id's texts give one, so no more rows than there are slots and languages sharing an id
        if slots
        else []
    )
    wanted = {(row["lang"], row["hash"]) for row in slots}
    texts: dict[str, list[str]] = {}
    for row in sorted(sample, key=lambda row: (row["lang"], row["hash"], row["text"])):
        if (row["lang"], row["hash"]) in wanted:
            texts.setdefault(row["lang"], []).append(row["text"])
    order = sorted(texts, key=lambda lang: (-sizes[lang], lang))
    return build_model({lang: texts[lang] for lang in order})


def build_model(texts: dict[str, list[str]]) -> LanguageModel:
    """Dictionaries from labelled texts, without what several of them share and without doubtful ones.

    A passage that goes through texts of many languages would draw its copies to any of
    them, so lines of more than one text are left out. Then each half of the sample is
    judged by the dictionaries of the other half, and only texts that keep their label stay.
    """
    distinct = {lang: list(dict.fromkeys(some)) for lang, some in texts.items()}
    seen = Counter(line for some in distinct.values() for text in some for line in set(text.split("\n")))
    own_lines = {
        lang: [
            plain_letters("\n".join(line for line in text.split("\n") if seen[line] == 1)[:SAMPLED_CHARS])
            for text in some
        ]
        for lang, some in distinct.items()
    }
    sample = {
        lang: [text for text in own_lines[lang] if text] or [plain_letters(text[:SAMPLED_CHARS]) for text in some]
        for lang, some in distinct.items()
    }
    halves = [{lang: some[k::2] for lang, some in sample.items()} for k in (0, 1)]
    agreed: dict[str, list[str]] = {lang: [] for lang in texts}
    for own, other in (halves, halves[::-1]):
        judge = Classifier(_dictionaries(other))
        for lang, some in own.items():
            agreed[lang] += [text for text in some if judge.classify(text)[0] == lang]
    return _dictionaries({lang: agreed[lang] or some for lang, some in sample.items()})


def _dictionaries(texts: dict[str, list[str]]) -> LanguageModel:
    # A dictionary of under 8 bytes is refused by the library.
    return LanguageModel({lang: " ".join(some).encode().ljust(8) for lang, some in texts.items()})


class Classifier:
    """Compressors of a model, one for each language."""

    def __init__(self, model: LanguageModel):
        self.languages = list(model.dictionaries)
        self._compressors = []
        for content in model.dictionaries.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self._compressors.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
                )
            )

    def sizes(self, text: str) -> list[int]:
        data = text.encode("utf-8", "surrogatepass")
        parts = [data[at : at + PART_BYTES] for at in range(0, len(data), PART_BYTES)]
        return [sum(len(one.compress(part)) for part in parts) for one in self._compressors]

    def classify(self, text: str) -> tuple[str, float, float, bool]:
        """Language, score, margin and whether the text is rejected."""
        letters = plain_letters(text)
        if not self.languages or not any(map(str.isalpha, letters)):
            return UNKNOWN, 0.0, 0.0, True
        sizes = self.sizes(letters)
        best = min(sizes)
        # A byte less means the text is that many times likelier, in powers of two.
        score = 1.0 / sum(2.0 ** max(-1000, best - size) for size in sizes)
        others = sorted(sizes)[1:]
        margin = (others[0] - best) / best if others else 1.0
        return self.languages[sizes.index(best)], score, margin, margin < NARROW_MARGIN


def classify(docs: DataFrame, model: LanguageModel, id_col: str, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """Per row of ``docs``: doc_id, the columns ``keep``, lang_pred, score, margin, rejected."""
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        *[column.alias(name) for name, column in keep.items()],
    )
    kept = [name for name in chosen.columns if name != "text"]
    fields = ", ".join(f"`{name}` {chosen.schema[name].dataType.simpleString()}" for name in kept)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model)
        for batch in batches:
            found = [classifier.classify(text) for text in as_texts(batch.column("text"))]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            columns = [pa.array(column, kind) for column, kind in zip(list(zip(*found)) or [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + columns,
                names=[*kept, "lang_pred", "score", "margin", "rejected"],
            )

    return arrow_map(chosen, predict, f"{fields}, lang_pred string, score double, margin double, rejected boolean")
