"""Token counts of a word-level BPE vocabulary, with a whole-token shortcut.

Most pre-tokens of a text are one token. Which vocabulary strings encode alone as themselves is proven once, on the
driver, by merging every one of them; a pre-token among those counts as one without any merging, only the rest is
merged. Counts add up over pre-tokens, and pre-tokens never run across white space, so counts of recurring chunks
between white space are remembered within a task.

The vocabulary file (its path is a parameter) is of the kind: NFC, white space, lower case; contractions, runs of
letters, single digits, runs of other characters; byte-level BPE with an end-of-word mark. Other kinds are refused.
Special strings in a text count as one token each, as by the library's default.

Defined cases: NULL and empty texts have no bytes and no tokens; repeated rows have the same result each; a text is
read whole, whatever its length; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from freightlane.llm.common import text_of

LIMIT = 2048
END = "</w>"
#: Chunks that a task remembers; beyond that it starts anew with the proven strings.
REMEMBERED = 800_000
#: The characters of Unicode's White_Space property.
WHITE_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: str.split() also splits at these, which are no white space in Unicode.
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself, or one of those from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """The rules of a vocabulary file and the strings proven to be one token."""

    def __init__(self, file: str, proven: dict[str, int] | None = None):
        self.file = file
        rules = json.loads(file)
        steps = [s["type"] for s in rules["normalizer"]["normalizers"]]
        splits = rules["pre_tokenizer"]["pretokenizers"]
        if (steps, [s["type"] for s in splits], rules["model"]["end_of_word_suffix"]) != (
            ["NFC", "Replace", "Lowercase"],
            ["Split", "ByteLevel"],
            END,
        ):
            raise ValueError(f"not a lower-case word vocabulary with {END}")
        self.tokens = sorted(rules["model"]["vocab"])
        self.pattern = splits[0]["pattern"]["Regex"]
        self.special = [t["content"] for t in rules["added_tokens"]]
        if proven is None:
            merge = Merger(self)
            proven = {w: 1 for w in self._whole() if merge(w) == 1}
        self.proven = proven

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """The rules in a file, with the strings proven on the spot."""
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    def _whole(self) -> Iterator[str]:
        """The texts of the vocabulary's whole words that are a pre-token by themselves."""
        own = {letter: b for b, letter in byte_letters().items()}
        find = regex.compile(self.pattern).findall
        for token in self.tokens:
            if token.endswith(END) and all(c in own for c in token[: -len(END)]):
                try:
                    word = bytes(own[c] for c in token[: -len(END)]).decode()
                except UnicodeDecodeError:
                    continue
                if find(word) == [word] and normal(word) == word:
                    yield word


class Merger:
    """How many tokens the vocabulary's merges leave of one pre-token."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokenize = Tokenizer.from_str(vocabulary.file).model.tokenize
        self.letters = byte_letters()

    def __call__(self, word: str) -> int:
        return len(self.tokenize(word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)))


def normal(text: str) -> str:
    """NFC and lower case, character by character: no final sigma."""
    text = unicodedata.normalize("NFC", text)
    return (text.replace("Σ", "σ") if "Σ" in text else text).lower()


class Counter(dict):
    """Chunk between white space -> its number of tokens, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.proven)
        self.vocabulary = vocabulary
        self.merge = Merger(vocabulary)
        self.find = regex.compile(vocabulary.pattern).findall
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or "(?!)")

    def __missing__(self, chunk: str) -> int:
        proven, merge = self.vocabulary.proven, self.merge
        self[chunk] = n = sum(proven.get(w) or merge(w) for w in self.find(chunk))
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        n = 0
        if any(s in text for s in self.vocabulary.special):
            parts = self.special.split(text)
            n, text = len(parts) - 1, None
        else:
            parts = [text]
        if len(self) > REMEMBERED:
            self.clear()
            self.update(self.vocabulary.proven)
        for part in parts:
            part = normal(part)
            chunks = WHITE_SPACE.split(part) if SEPARATORS.search(part) else part.split()
            n += sum(map(self.__getitem__, chunks))
        return n


def token_counts(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, over_limit of every document. The rules go to the tasks with the broadcast of one vocabulary."""
    proven = Vocabulary.read(vocabulary)
    rules = docs.sparkSession.sparkContext.broadcast((proven.file, proven.proven))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(*rules.value))
        for batch in batches:
            tokens = pa.array([counter.count(t.as_py()) for t in batch["text"]], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["id"], batch["n_bytes"], tokens], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"), text_of(text).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
