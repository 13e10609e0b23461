"""Piece encoding with a merge-type vocabulary, by a table of each prefix's last token.

Merging pairs by score has this property: the encoding of a prefix of a text is the
encoding of a shorter prefix plus one token, and that last token is unique.  So a text is
encoded from left to right: an automaton finds all pieces that end at a position, and the
one that may follow the last token of the prefix before it is stored.  Whether token ``b``
may follow ``a`` is decided by undoing the merges on both sides of their border: they stay
apart if at no time a pair across the border would have merged earlier than its neighbours.
The ids are then read backwards from the end of the table.

Where no piece of the vocabulary spans two adjacent characters, no merge ever crosses them;
texts are cut there into chunks, and the encodings of chunks are remembered.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty
text; characters outside the vocabulary become the ids of their UTF-8 bytes; repeated rows
give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_frames, ship, whole_text

SPACE = "▁"
#: Words (and chunks of them) that a worker remembers, in two generations: a full one becomes the old one.
MEMORY = 400_000
#: Characters tried as borders of words, beside the space.
MARKS = ".,|!?;:\n"
#: Characters that often end a word; a word and its tail are remembered apart where no piece joins them.
TAILS = ".,;:!?"


class PieceCoder:
    """Encoder and decoder of one vocabulary file (identity normalisation, byte fallback)."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        plain = [i for i in range(len(self.pieces))
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id_of = {self.pieces[i]: i for i in plain}
        # merges happen by falling score; characters are there from the start
        order = sorted((i for i in plain if len(self.pieces[i]) > 1), key=lambda i: (-sp.get_score(i), i))
        self.rank = {i: -1 for i in plain}
        last = None
        for r, i in enumerate(order):
            if last is not None and sp.get_score(i) == sp.get_score(last):
                self.rank[i] = self.rank[last]  # a tie: the leftmost pair goes first
            else:
                self.rank[i] = r
            last = i
        self.size = [len(p) for p in self.pieces]
        self.halves: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self._add(i)
        self.automaton.make_automaton()
        self.no_bytes = set(self.byte_of).isdisjoint
        self.characters = set("".join(self.id_of))
        self.bigrams = {p[k:k + 2] for p in self.id_of for k in range(len(p) - 1)}
        self.spaces_lead = not any(b[1] == SPACE and b[0] != SPACE for b in self.bigrams) and SPACE in self.id_of
        # marks that no piece joins to anything but a space before them or to each other
        joined = [b for b in self.bigrams if b[0] != SPACE]
        marks = {c for c in MARKS if not any(c in b and not (b[0] in MARKS and b[1] in MARKS) for b in joined)}
        marks = "".join(sorted(re.escape(c) for c in marks if not any(c in b and not set(b) <= marks for b in joined)))
        self.cut = re.compile(f" ?[^ {marks}]+| ?[{marks}]+" if marks else " ?[^ ]+").findall
        self.memory: dict[str, list[int]] = {}
        self.words: dict[str, str | tuple[str, str]] = {}
        self.old_words: dict[str, str | tuple[str, str]] = {}
        self.apart: dict[int, bool] = {}

    def _add(self, i: int) -> None:
        """Put a piece into the automaton if merging can build it; note the halves of its last merge."""
        piece = self.pieces[i]
        if len(piece) > 1:
            parts = [self.id_of.get(c) for c in piece]
            if None in parts:
                return
            while len(parts) > 2:
                found = [(self.rank[j], k) for k in range(len(parts) - 1)
                         if (j := self.id_of.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]])) is not None]
                if not found:
                    return
                k = min(found)[1]
                parts[k:k + 2] = [self.id_of[self.pieces[parts[k]] + self.pieces[parts[k + 1]]]]
            self.halves[i] = (parts[0], parts[1])
        self.automaton.add_word(piece, i)

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging leaves ``a`` and ``b`` apart where they stand next to each other."""
        key = a << 20 | b
        if (known := self.apart.get(key)) is None:
            if len(self.apart) > MEMORY:
                self.apart.clear()
            known = self.apart[key] = self._stay_apart(a, b)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        pieces, rank, halves = self.pieces, self.rank, self.halves
        # before a pair across the border may merge, a's or b's own next merge has to be later
        before, ties_lose = float("inf"), False
        while True:
            joint = self.id_of.get(pieces[a] + pieces[b])
            if joint is not None and (rank[joint] < before or rank[joint] == before and not ties_lose):
                return False
            # go back in time: undo the later of the two last merges (of equal ones the right one)
            if a in halves and (b not in halves or rank[a] > rank[b]):
                before, ties_lose, a = rank[a], True, halves[a][1]
            elif b in halves:
                before, ties_lose, b = rank[b], False, halves[b][0]
            else:
                return True

    def _chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk whose characters are all in the vocabulary."""
        if chunk in self.id_of and (len(chunk) == 1 or self.id_of[chunk] in self.halves):
            return [self.id_of[chunk]]
        last = [-1] * len(chunk)  # the last token of each prefix
        size, known, stay = self.size, self.apart, self.may_follow
        for end, i in self.automaton.iter(chunk):
            if last[end] < 0:
                before = end - size[i]
                if before < 0:
                    last[end] = i
                elif (a := last[before]) >= 0:
                    if (ok := known.get(a << 20 | i)) is None:
                        ok = stay(a, i)
                    if ok:
                        last[end] = i
        ids, at = [], len(chunk) - 1
        while at >= 0:
            ids.append(i := last[at])
            at -= size[i]
        return ids[::-1]

    def encode_span(self, span: str) -> list[int]:
        """Ids of text whose spaces are already ``SPACE``; cuts where nothing in the vocabulary spans."""
        ids: list[int] = []
        start = 0
        for k in range(1, len(span) + 1):
            if k == len(span) or span[k - 1:k + 1] not in self.bigrams:
                chunk = span[start:k]
                if len(chunk) == 1 and chunk not in self.id_of:
                    ids += [self.byte_ids[x] for x in chunk.encode()]
                else:
                    ids += self._remembered(chunk)
                start = k
        return ids

    def _remembered(self, chunk: str) -> list[int]:
        if len(chunk) > 64:
            return self._chunk(chunk)
        if (ids := self.memory.get(chunk)) is None:
            if len(self.memory) > MEMORY // 4:
                self.memory.clear()
            ids = self.memory[chunk] = self._chunk(chunk)
        return ids

    def encode(self, text: str) -> list[int]:
        return self.encode_span(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, the leading space cut, bytes read as UTF-8 (a bad byte gives U+FFFD)."""
        if self.no_bytes(ids):
            text = "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")
            return text[1:] if text[:1] == " " else text
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if (byte := self.byte_of.get(i)) is not None:
                run.append(byte)
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(self.pieces[i])
        if run:
            out.append(_utf8(bytes(run)))
        if out and ids and ids[0] not in self.byte_of and out[0].startswith(SPACE):
            out[0] = out[0][1:]
        return "".join(x.replace(SPACE, " ") for x in out)

    def _word(self, word: str) -> str | tuple[str, str]:
        """Ids joined by commas, of a word as ``cut`` gives it; with its decoded text if that isn't the word."""
        if (known := self.old_words.get(word)) is None:
            body = word.rstrip(TAILS)
            if body.strip() and len(body) < len(word) and word[len(body) - 1:len(body) + 1] not in self.bigrams:
                tail = word[len(body):]
                both = [self.words.get(x) or self._word(x) for x in (body, tail)]
                known = ",".join(both) if all(isinstance(x, str) for x in both) else None
            if known is None:
                span = word.replace(" ", SPACE)
                ids = self._chunk(span) if self.characters.issuperset(span) else self.encode_span(span)
                text = self.decode([self.id_of[SPACE], *ids])
                joined = ",".join(map(str, ids))
                known = joined if text == word else (joined, text)
        if len(word) <= 64:
            if len(self.words) >= MEMORY:
                self.old_words, self.words = self.words, {}
            self.words[word] = known
        return known

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, text decoded from them).

        Words are encoded one by one, and remembered: a word begins with its space or behind
        a mark that no piece joins to other characters.  Texts with runs of spaces are encoded
        in one go.
        """
        if not text:
            return 0, "", ""
        spaced = " " + text
        if "  " in spaced or spaced[-1] == " " or SPACE in text or not self.spaces_lead:
            ids = self.encode(text)
            return len(ids), ",".join(map(str, ids)), self.decode(ids)
        known = self.words
        cut = self.cut(spaced)
        found = [known.get(w) or self._word(w) for w in cut]
        try:
            ids = ",".join(found)
            decoded = "".join(cut)[1:]  # each word decodes to itself
        except TypeError:
            decoded = "".join([w if isinstance(x, str) else x[1] for w, x in zip(cut, found)])[1:]
            ids = ",".join([x if isinstance(x, str) else x[0] for x in found])
        return ids.count(",") + 1, ids, decoded


def _utf8(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out = []
        while data:
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[:n].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                n = 1
                out.append("�")
            data = data[n:]
        return "".join(out)


@lru_cache(maxsize=2)
def coder(model_file: str) -> PieceCoder:
    return PieceCoder(model_file)


def encode_and_decode(docs: DataFrame, model_file: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and the ids and the decoded text) of every text."""
    ship(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = coder(model_file)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                n, ids, decoded = c.round_trip(text)
                row = (None if pd.isna(doc_id) else int(doc_id), n, sha(ids), sha(decoded))
                rows.append((*row, [int(x) for x in ids.split(",") if x], decoded) if with_ids else row)
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")], dtype=object)  # pandas would make ids beside a null floats
            yield out

    return map_frames(docs.select("doc_id", whole_text().alias("text")), run, schema)
