"""SentencePiece encoding by a table of last tokens, and decoding, for BPE models with byte fallback.

Of the encoding of every prefix of a text only the last token is stored. It is the one token that ends there (found by
an automaton over all pieces) and is compatible with the last token of the prefix before it; the ids are recovered
backwards. Merges are never simulated on texts.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import exact, restored, schema_of, small_batches

# What a model writes for a space.
SPACE = "▁"
# Words that a worker remembers before it starts anew; pairs of tokens are twice as many.
REMEMBERED = 300_000
# Rows of whole texts and ids in one batch of a worker.
BATCH_ROWS = 200

codecs.register_error("each_byte", lambda error: ("�" * (error.end - error.start), error.end))


class Vocabulary:
    """Pieces of a model, when each is made, and of which two it is made last. Bounded by the model; texts add nothing."""

    def __init__(self, model_file: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.digest = hashlib.sha256(model.serialized_model_proto()).hexdigest()
        probe = f" a  b\tＡ{SPACE}"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that keep texts as they are and put a space before them")
        ids = range(model.get_piece_size())
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in ids]
        names = [model.id_to_piece(i) for i in ids]
        self.end_id = model.eos_id()
        self.byte_ids = {int(names[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        if len(self.byte_ids) < 256 or self.end_id < 0:
            raise ValueError("only models with all bytes and an end id")
        plain = [i for i in ids if not special[i]]
        self.surface = [" ⁇ " if model.is_unknown(i) else "" if special[i] else names[i].replace(SPACE, " ") for i in ids]
        self.piece = {names[i]: i for i in plain}
        if {c for name in self.piece for c in name} - self.piece.keys():
            raise ValueError("only models in which every character of a piece is a piece")
        # Pieces of better score are made earlier; single characters are there from the start.
        self.when = {i: -1.0 if len(names[i]) == 1 else -model.get_score(i) for i in plain}
        self.halves: dict[int, tuple[int, int]] = {}
        self.usable = {name: i for name, i in self.piece.items() if self._made_alone(name)}
        self.length = {i: len(name) for name, i in self.usable.items()}
        self.name = {i: name for name, i in self.usable.items()}

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Vocabulary) and other.digest == self.digest

    def __hash__(self) -> int:
        return hash(self.digest)

    def _made_alone(self, name: str) -> bool:
        """Whether merging turns the text of a piece into that piece; only such pieces ever occur. Notes the last merge."""
        parts, latest = list(name), -1.0
        while len(parts) > 1:
            merges = [(self.when[self.piece[a + b]], n) for n, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.piece]
            if not merges:
                return False
            when, n = min(merges)
            if when < latest:
                raise ValueError("only models whose merges never come out of the order of their scores")
            latest = when
            if len(parts) == 2:
                self.halves[self.piece[name]] = (self.piece[parts[0]], self.piece[parts[1]])
            parts[n : n + 2] = [parts[n] + parts[n + 1]]
        return True


class Encoder:
    """Encodes texts with a vocabulary. Remembers a bounded number of words and of compatible pairs."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.known = vocabulary
        self.ends = ahocorasick.Automaton()
        for name, i in vocabulary.usable.items():
            self.ends.add_word(name, i)
        self.ends.make_automaton()
        known = "".join(re.escape(c) for c in sorted(vocabulary.usable) if len(c) == 1)
        # Characters of no piece stand alone.
        self.parts = re.compile(f"[{known}]+|[^{known}]")
        # If no piece has a space after another character, texts also fall apart before spaces.
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in vocabulary.usable)
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, list[int]] = {}
        self.after_space: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text with the end id. Null is empty, and an empty text has the end id only."""
        if not text:
            return [self.known.end_id]
        if not self.apart:
            return [*self._word(SPACE + text.replace(" ", SPACE)), self.known.end_id]
        ids: list[int] = []
        after_space = self.after_space
        more = ""
        for word in text.replace(SPACE, " ").split(" "):
            if not word:
                more += SPACE
                continue
            if more:
                ids += self._word(more + SPACE + word)
                more = ""
                continue
            found = after_space.get(word)
            if found is None:
                found = self._word(SPACE + word)
                if len(word) <= 32:
                    if len(after_space) >= REMEMBERED:
                        after_space.clear()
                    after_space[word] = found
            ids += found
        if more:
            ids += self._word(more)
        ids.append(self.known.end_id)
        return ids

    def _word(self, word: str) -> list[int]:
        parts = self.parts.findall(word)
        return self._part(word) if len(parts) == 1 else [i for part in parts for i in self._part(part)]

    def _part(self, part: str) -> list[int]:
        found = self.seen.get(part)
        if found is None:
            if len(part) == 1 and part not in self.known.usable:
                found = [self.known.byte_ids[b] for b in part.encode()]
            else:
                found = self._recovered(self._last_tokens(part))
            if len(part) <= 32:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen[part] = found
        return found

    def _last_tokens(self, part: str) -> list[int]:
        """The last token of the encoding of each prefix."""
        length, pairs = self.known.length, self.pairs
        last = [-1] * len(part)
        for end, token in self.ends.iter(part):
            if last[end] < 0:
                before = end - length[token]
                if before < 0:
                    last[end] = token
                    continue
                pair = last[before] << 32 | token
                stays = pairs.get(pair)
                if stays is None:
                    if len(pairs) >= 2 * REMEMBERED:
                        pairs.clear()
                    stays = pairs[pair] = self._stays(last[before], token)
                if stays:
                    last[end] = token
        return last

    def _recovered(self, last: list[int]) -> list[int]:
        ids, at = [], len(last) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self.known.length[last[at]]
        return ids[::-1]

    def _stays(self, left: int, right: int) -> bool:
        """Whether no merge ever joins the two tokens where they meet.

        Both grow from the characters beside the border. Of merges at the same time the one further left comes first, so
        the left side's growth comes before a merge across the border, and that before the right side's.
        """
        piece, when, name = self.known.piece, self.known.when, self.known.name
        rights, lefts = self._spine(left, 1), self._spine(right, 0)
        i, j, never = len(rights) - 1, len(lefts) - 1, float("inf")
        while True:
            left_grows = when[rights[i - 1]] if i else never
            right_grows = when[lefts[j - 1]] if j else never
            across = piece.get(name[rights[i]] + name[lefts[j]])
            if across is not None and when[across] < left_grows and when[across] <= right_grows:
                return False
            if not i and not j:
                return True
            if left_grows <= right_grows:
                i -= 1
            else:
                j -= 1

    def _spine(self, token: int, side: int) -> list[int]:
        """The token and, ever smaller, the parts of it that lie at one of its ends."""
        out = [token]
        while token in self.known.halves:
            token = self.known.halves[token][side]
            out.append(token)
        return out


@lru_cache(maxsize=1)
def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One a worker: what it remembers serves the next task, too."""
    return Encoder(vocabulary)


class Decoder:
    """Decodes ids with a vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.surface = vocabulary.surface
        self.byte = {i: b for b, i in vocabulary.byte_ids.items()}

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: control ids have none, bytes that are no UTF-8 become U+FFFD each, the first space goes."""
        out: list[str] = []
        raw = bytearray()
        begun = False
        for i in ids:
            byte = self.byte.get(i)
            if byte is not None:
                raw.append(byte)
                continue
            if raw:
                out.append(raw.decode("utf-8", "each_byte"))
                raw.clear()
                begun = True
            text = self.surface[i]
            if text:
                if not begun and text[0] == " " and text != " ⁇ ":
                    text = text[1:]
                begun = True
                out.append(text)
        out.append(raw.decode("utf-8", "each_byte"))
        return "".join(out)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "ids", decoded: str | None = None) -> DataFrame:
    """`docs` without its text column and with `name`, the ids (array<int>) of every whole text, end id included.

    With `decoded`, the text that the ids decode to comes as a further column of that name. One pass over the rows
    without a shuffle, whatever columns they have; names that clash get underscores. Null and empty texts have the end
    id only and decode to an empty text; repeated rows stay, each with its ids; an empty table gives no rows.
    """
    added = [(name, "array<int>"), (decoded, "string")][: 2 if decoded else 1]

    def run(texts: pd.Series) -> list[list]:
        encoder, decoder = _encoder(vocabulary), Decoder(vocabulary)
        ids = [encoder.encode(x) for x in texts]
        out = [[np.array(x, np.int32) for x in ids]]
        return [*out, [decoder.decode(x) for x in ids]] if decoded else out

    return _replaced(docs, text, added, run)


def decode(frame: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "text") -> DataFrame:
    """`frame` without its column of ids and with `name`, their text. Null ids (or a null among them) have none."""

    def run(lists: pd.Series) -> list[list]:
        decoder = Decoder(vocabulary)
        return [["" if x is None else decoder.decode(int(i) for i in x if i is not None and i == i) for x in lists]]

    return _replaced(frame, ids, [(name, "string")], run)


def _replaced(frame: DataFrame, column: str, added: list[tuple[str, str]], run: Callable[[pd.Series], list[list]]) -> DataFrame:
    """`frame` without a column and with those that `run` makes of it, (name, type) each, in one pass over the rows."""
    kept = [c for c in frame.columns if c != column]
    whole = frame.select(*[F.col(f"`{c}`") for c in [*kept, column]])
    names = list(kept)
    for name, _ in added:
        while name.lower() in {c.lower() for c in names}:
            name += "_"
        names.append(name)
    # Plain names on the way, as a worker's columns may have no dots in theirs.
    carried = exact(whole.toDF(*[f"c{n}" for n in range(len(kept) + 1)]))
    others = carried.columns[:-1]

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in small_batches(frames, BATCH_ROWS):
            out = part[others].copy()
            for n, values in enumerate(run(part[carried_name])):
                out[f"new{n}"] = pd.Series(values, out.index, dtype=object)
            yield out

    carried_name = carried.columns[-1]
    schema = [*([schema_of(carried.select(*others))] if others else []), *[f"new{n} {kind}" for n, (_, kind) in enumerate(added)]]
    return restored(carried.mapInPandas(each, ", ".join(schema)), whole.drop(column)).toDF(*names)
