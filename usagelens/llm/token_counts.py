"""Token counts under a unigram vocabulary, with dynamic programming shared along a trie.

The best segmentation of a prefix does not depend on what follows it. Distinct pre-tokens
are inserted in a trie of their characters; walking it, the forward score of every prefix is
computed once however many pre-tokens share it, and a pre-token's count of tokens is stored
where it ends. Documents then add up stored counts.
"""

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log

from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from usagelens.llm.common import identified, map_batches, pieces, ship

SPACE = "▁"  # stands before every pre-token, as in the vocabulary file

# Pre-tokens a worker remembers, about 100 MB at most.
REMEMBERED = 600_000
# Bytes of text that share one trie; the more, the more prefixes are shared.
SHARED_TEXT = 1 << 22


class Trie:
    """Distinct pre-tokens by their characters; ``END`` marks where one ends."""

    END = ""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for character in word:
                node = node.setdefault(character, {})
            node[self.END] = word

    def walk(self) -> Iterator[tuple[int, str, str | None]]:
        """(depth, character, pre-token that ends here or None), every node once, parents first."""
        open_nodes = [iter(self.root.items())]
        while open_nodes:
            for character, node in open_nodes[-1]:
                if character != self.END:
                    yield len(open_nodes), character, node.get(self.END)
                    open_nodes.append(iter(node.items()))
                    break
            else:
                open_nodes.pop()


class Unigram:
    """Log-probabilities of tokens; characters no token covers count one token per byte."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.lengths = sorted({len(t) for t in scores})
        self.unknown = min(scores.values(), default=0.0) - 10.0
        self.known: dict[str, int] = {}

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Per pre-token the tokens of its best segmentation; of equals the one with fewest."""
        longest = max(self.lengths, default=0)
        scores, found = self.scores, {}
        # By depth: forward score and tokens of the prefix that ends there.
        best, tokens, prefix = [0.0], [0], []
        for depth, character, word in Trie(words).walk():
            del best[depth:], tokens[depth:], prefix[depth - 1 :]
            prefix.append(character)
            tail = "".join(prefix[-longest:]) if longest else ""
            size = len(character.encode("utf-8", "surrogatepass"))
            top, count = best[-1] + self.unknown * size, tokens[-1] + size
            for length in self.lengths:
                if length > len(tail):
                    break
                score = scores.get(tail[-length:])
                if score is not None:
                    score += best[depth - length]
                    n = tokens[depth - length] + 1
                    if score > top or score == top and n < count:
                        top, count = score, n
            best.append(top)
            tokens.append(count)
            if word is not None:
                found[word] = count
        return found

    def count_texts(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens and pre-tokens of every text; a pre-token is what stands between white space."""
        split = [t.split() for t in texts]
        new = {w for words in split for w in words} - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = {w for words in split for w in words}
        for word, n in self.counts([SPACE + w for w in new]).items():
            self.known[word[1:]] = n
        known = self.known
        return [sum([known[w] for w in words]) for words in split], [len(words) for words in split]


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    """The pieces of a sentencepiece file, with the log-probabilities their ranks have by Zipf's law.

    The files hold ranks and no probabilities; token counts need some, and none are trained.
    """
    model = SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = log(sum(1 / (rank + 1) for rank in range(len(plain))))
    return Unigram({piece: -log(rank + 1) - total for rank, piece in enumerate(plain)})


def count_tokens(
    docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, n_pretokens), one row per row of ``docs``, over its whole text.

    ``vocab`` names a sentencepiece file, at the same place on every executor. NULL, empty
    and white texts have 0 tokens. Repeated rows get equal counts, a NULL id stays NULL, an empty
    table gives no rows, and other columns are not read.
    """
    ship(docs.sparkSession)

    def count(batch):
        model, tokens, words = unigram(vocab), [], []
        for part in pieces(batch.column(1), SHARED_TEXT):
            more_tokens, more_words = model.count_texts(part.to_pylist())
            tokens += more_tokens
            words += more_words
        return {"doc_id": batch.column(0), "n_tokens": tokens, "n_pretokens": words}

    schema = "doc_id long, n_tokens long, n_pretokens long"
    return map_batches(identified(docs, id_col, text_col), count, schema)
