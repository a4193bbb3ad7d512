"""SentencePiece BPE models as tables: which pieces may follow one another.

The encoding of a text is the only way to cut it into pieces of which every two
neighbours are what the model makes of those two alone. (Merges inside two neighbouring
pieces do not depend on the rest of the text unless something merges across their outer
ends, and then they would not be pieces.) So a cut can be found from left to right, or
from any chunk, by checking pairs; pairs are decided once and remembered.

Used by the token counts and by the encoder.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import sentencepiece

from cartwheel.llm.common import remembers

SPACE = "▁"
#: Stands for a character without a piece: written as its UTF-8 bytes, merged with nothing.
BYTES = -1
#: Latin letters, as against everything else.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"


class PieceModel:
    """Pieces, scores and pair decisions of one ``.model`` file of the BPE kind."""

    #: Remembered pairs; forgotten all at once when there are more.
    REMEMBER = 500_000

    def __init__(self, path: str):
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text_of = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        plain = [i for i in range(len(self.text_of))
                 if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        self.score = {self.text_of[i]: p.get_score(i) for i in plain}
        self.byte_id = {int(self.text_of[i][3:5], 16): i for i in range(len(self.text_of)) if p.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("a model with byte fallback is needed")
        probe = p.encode("x x")
        if not p.id_to_piece(probe[0]).startswith(SPACE) or p.encode("a  b") == p.encode("a b"):
            raise ValueError("a model that marks the start and keeps repeated blanks is needed")
        self.processor = p
        self.pairs: dict[int, bool] = {}  # by left * 2**32 + right
        # a line end before a text keeps the library's first blank away from it
        self.lead = len(p.encode("\n"))
        # pieces that merging never makes cannot occur
        self.id_of = {self.text_of[i]: i for i in plain if self.alone(self.text_of[i]) == [i]}
        self.longest = max(map(len, self.id_of))
        # the longest piece with such an end, by its last two characters
        self.reach: dict[str, int] = {}
        for x in self.id_of:
            self.reach[x[-2:]] = max(self.reach.get(x[-2:], 1), len(x))
        # where usual models cut every text: before a blank after another character, around
        # line ends, where Latin letters begin or end. A model with other pieces gets texts whole.
        other = f"[^{LATIN}{SPACE}]"
        crossing = re.compile(f"[^{SPACE}]{SPACE}|\n|[{LATIN}]{other}|{other}[{LATIN}]")
        self.crossing = [x for x in self.id_of if crossing.search(x)]
        self.segments = re.compile(
            r"[\s\S]+" if self.crossing else f" *[{LATIN}]+| *[^ \n{LATIN}]+|\n| +")

    def alone(self, text: str) -> list[int]:
        """What the model makes of a short text without a blank before it."""
        return self.processor.encode("\n" + text)[self.lead:]

    def follows(self, left: int, right: int) -> bool:
        """Whether piece ``right`` may stand after piece ``left``."""
        if left == BYTES or right == BYTES:
            return True
        known = self.pairs.get(left << 32 | right)
        if known is None:
            known = self.alone(self.text_of[left] + self.text_of[right]) == [left, right]
            if len(self.pairs) >= self.REMEMBER:
                self.pairs.clear()
            self.pairs[left << 32 | right] = known
        return known

    def prefixes(self, segments: Iterable[str]) -> Iterator[tuple[str, list[int], list[int], list[int]]]:
        """Dynamic program over the prefixes of segments (blanks as ``SPACE``).

        For every prefix of a segment: the exact number of its tokens, its last piece and
        that piece's length. The last piece of a prefix is the one piece at its end that
        may follow the last piece of what is before it. A segment takes over the prefixes
        that it shares with the one before it, so sorted segments cost least. The lists
        belong to the next segment as soon as it is asked for.
        """
        id_of, pairs, reach = self.id_of, self.pairs, self.reach
        before, count, last, size = "", [0], [BYTES], [0]
        for segment in segments:
            n, same = len(segment), 0
            for x, y in zip(before, segment):
                if x != y:
                    break
                same += 1
            del count[same + 1:], last[same + 1:], size[same + 1:]
            for i in range(same + 1, n + 1):
                for j in range(max(0, i - reach.get(segment[max(0, i - 2):i], 1)), i):
                    piece = id_of.get(segment[j:i])
                    if piece is None:
                        continue
                    left = last[j]
                    if left == BYTES:
                        break
                    fits = pairs.get(left << 32 | piece)
                    if self.follows(left, piece) if fits is None else fits:
                        break
                else:
                    # no piece ends here: a character of its own, as bytes
                    count.append(count[i - 1] + len(segment[i - 1].encode()))
                    last.append(BYTES)
                    size.append(1)
                    continue
                count.append(count[j] + 1)
                last.append(piece)
                size.append(i - j)
            before = segment
            yield segment, count, last, size

    def back(self, segment: str, last: list[int], size: list[int]) -> list[int]:
        """Token ids of a segment, walking back from its end."""
        out: list[int] = []
        i = len(segment)
        while i:
            if last[i] == BYTES:
                out += [self.byte_id[b] for b in reversed(segment[i - 1].encode())]
            else:
                out.append(last[i])
            i -= size[i]
        return out[::-1]


@remembers
@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model per Python worker, whatever the number of tasks."""
    return PieceModel(path)
