"""Token counts by unigram segmentation, with forward scores shared along a trie of the distinct pretokens."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import common

VOCABULARY = "piece_bpe_32k.model"
#: Words whose counts a Python worker keeps; beyond that, new ones are kept for their block of texts only.
MEMO = 400_000
#: Characters of a word down to which trie nodes are held, so that endless words don't fill the memory.
DEPTH = 200
#: The sign that stands for the space before a word in the vocabulary.
SPACE = "▁"
RESULT = "struct<n_words:bigint,n_tokens:bigint,score:bigint>"


def pieces(path: str) -> tuple[dict[str, int], int]:
    """Costs of the pieces of a vocabulary, and the cost of one byte of a character that no piece covers.

    The file ranks its pieces by how common they are and holds no frequencies, so they follow Zipf's law: the piece of
    rank r has the cost -log(1 / (r + 2)), in millionths, as whole numbers (sums don't depend on their order).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    costs, rank = {}, 0
    for number in range(model.get_piece_size()):
        if not (model.is_control(number) or model.is_unknown(number) or model.is_byte(number) or model.is_unused(number)):
            costs[model.id_to_piece(number)] = round(1e6 * math.log(rank + 2))
            rank += 1
    return costs, round(1e6 * math.log(rank + 2)) + 1_000_000


class Trie:
    """Best segmentations of all prefixes of the words put in.

    A node is a prefix of some word. It holds the least cost of segmenting that prefix with the least number of tokens
    at that cost (one integer: cost * 2^32 + tokens), and the states of the pieces that may go on below it. Both depend
    on the prefix alone, so words with a common prefix share its nodes. Words go in sorted, which walks the trie depth
    first: a node is worked out once and is not needed after its branch, so only the current branch is held.
    """

    def __init__(self, costs: dict[str, int], byte_cost: int):
        self.byte_cost = (byte_cost << 32) + 1
        #: The pieces as a trie of their own: (state, character) to state, and what a piece that ends in a state costs.
        self.step: dict[tuple[int, str], int] = {}
        self.ends: list[int] = [0]
        for piece, cost in costs.items():
            state = 0
            for char in piece:
                state = self.step.setdefault((state, char), len(self.ends))
                if state == len(self.ends):
                    self.ends.append(0)
            self.ends[state] = (cost << 32) + 1
        self.alone = {p for p in costs if len(p) == 1}

    def below(self, char: str, best: int, states: list[int], values: list[int]) -> tuple[int, list[int], list[int]]:
        """The node that ``char`` leads to."""
        new = -1 if char in self.alone else best + len(char.encode("utf-8", "replace")) * self.byte_cost
        step, ends = self.step, self.ends
        going, held = [], []
        for state, value in zip(states, values):
            after = step.get((state, char))
            if after is not None:
                going.append(after)
                held.append(value)
                own = ends[after]
                if own and (new < 0 or value + own < new):
                    new = value + own
        going.append(0)
        held.append(new)
        return new, going, held

    def insert_sorted(self, words: list[str]) -> Iterator[int]:
        """Cost and count of each word, as one integer. Nodes below ``DEPTH`` are not shared."""
        branch, last, below = [(0, [0], [0])], "", self.below
        for word in words:
            depth, most = 0, min(len(word), len(last), DEPTH)
            while depth < most and word[depth] == last[depth]:
                depth += 1
            del branch[depth + 1 :]
            node = branch[-1]
            for at in range(depth, len(word)):
                node = below(word[at], *node)
                if at < DEPTH:
                    branch.append(node)
            last = word
            yield node[0]


_models: dict[str, tuple[Trie, dict[bytes, int]]] = {}


def counts(text: Column | str, path: str | None = None, most: int = MEMO) -> Column:
    """Words, tokens and cost of each whole text as a struct.

    Words are runs of anything but the six ASCII spaces; each is a pretoken with the space sign before it. Its tokens
    are those of the cheapest segmentation into pieces (fewest tokens among equals); characters that no piece covers
    count a token for each byte. Null and empty texts have zeros. Each row is worked alone: ties, repeated rows and
    other columns play no part.
    """
    path = path or common.tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if path not in _models:
            _models[path] = Trie(*pieces(path)), {}
        trie, terminal = _models[path]
        gc.disable()  # no cycles are made here, and there are many small objects to look through
        for texts in batches:
            out = []
            for some in common.blocks(common.as_bytes(texts)):
                rows = [x.split() for x in some]
                new = {(SPACE + w.decode("utf-8", "replace")): w for row in rows for w in row if w not in terminal}
                order = sorted(new)
                found = {new[w]: value for w, value in zip(order, trie.insert_sorted(order))}
                if len(terminal) < most:
                    terminal.update(found)
                get, other = terminal.get, found.get
                for row in rows:
                    total = sum([get(w) or other(w) for w in row])
                    out.append((len(row), total & 0xFFFFFFFF, total >> 32))
            table = np.array(out, dtype=np.int64).reshape(-1, 3)
            yield pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(3)], ["n_words", "n_tokens", "score"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return common.struct_column(common.arrow_udf(run, RESULT), text)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    return docs.select("doc_id", counts(docs["text"]).alias("c")).select("doc_id", "c.n_words", "c.n_tokens", "c.score")
