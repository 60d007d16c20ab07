"""Counts of whole texts and of their lines, by array operations over a slice."""

from __future__ import annotations

import numpy as np

from riskfeat.llm.textops import IS_SEP, all_word_hashes, shingle_hashes, word_hashes, word_spans

SYMBOLS = b"#*$%&|<>"
# classes of bytes
SEP, UPPER, LOW, DIGIT, SYMBOL, STOP, BANG, OTHER, WIDE, MORE = range(10)  # MORE: UTF-8 continuation
KIND = np.full(256, OTHER, np.uint8)
KIND[IS_SEP] = SEP
KIND[65:91], KIND[97:123], KIND[48:58] = UPPER, LOW, DIGIT
KIND[list(SYMBOLS)] = SYMBOL
KIND[list(b".,;:?")] = STOP
KIND[list(b"!")] = BANG
KIND[0x80:0xC0], KIND[0xC0:] = MORE, WIDE
KINDS = 10


class Texts:
    """Words, lines and byte classes of the texts in one slice."""

    def __init__(self, data: np.ndarray, offs: np.ndarray) -> None:
        self.data, self.offs, self.rows = data, offs, len(offs) - 1
        self.row, self.start, self.end = word_spans(data, offs)
        self.hash = all_word_hashes(data, self.start, self.end)
        self.n_words = np.bincount(self.row, minlength=self.rows)
        # lines: every text has one, and one more after each line feed
        feed = np.flatnonzero(data == 10)
        feed_row = np.searchsorted(offs, feed, side="right") - 1
        begin = np.concatenate([offs[:-1], feed + 1])
        row = np.concatenate([np.arange(self.rows), feed_row])
        order = np.lexsort((begin, row))
        self.line_start, self.line_row = begin[order], row[order]
        self.n_lines = np.bincount(row, minlength=self.rows)
        last = np.cumsum(self.n_lines) - 1
        self.line_end = np.empty_like(self.line_start)
        self.line_end[:-1] = self.line_start[1:] - 1
        self.line_end[last] = offs[1:]
        self.first_line = last - self.n_lines + 1
        # a word's line: the last line of its row that starts at or before it
        feeds = np.repeat(np.arange(len(feed) + 1), np.diff(np.searchsorted(self.start, feed), prepend=0, append=len(self.start)))
        before = np.searchsorted(feed, offs[:-1])
        self.line = self.first_line[self.row] + feeds - before[self.row]
        self.line_words = np.bincount(self.line, minlength=len(self.line_row))

    def kinds(self, by_line: bool = False) -> np.ndarray:
        """Bytes of each class, per text or per line (line feeds left out)."""
        k = KIND[self.data].astype(np.int64)
        if by_line:
            n = self.line_end - self.line_start
            at = np.arange(int(n.sum())) + np.repeat(self.line_start - (np.cumsum(n) - n), n)
            owner, k, rows = np.repeat(np.arange(len(n)), n), k[at], len(n)
        else:
            owner, rows = np.repeat(np.arange(self.rows), np.diff(self.offs)), self.rows
        return np.bincount(owner * KINDS + k, minlength=rows * KINDS).reshape(rows, KINDS)

    def repeated_lines(self) -> np.ndarray:
        """Per line: has a word and equals an earlier line of its text."""
        some = np.flatnonzero(self.line_words > 0)
        h = word_hashes(self.data, self.line_start[some], self.line_end[some])
        order = np.lexsort((some, h, self.line_row[some]))
        r, x = self.line_row[some][order], h[order]
        out = np.zeros(len(self.line_row), bool)
        out[some[order[1:][(r[1:] == r[:-1]) & (x[1:] == x[:-1])]]] = True
        return out

    def repeated_words(self, window: int) -> np.ndarray:
        """Per text: words in windows of that many words found twice or more in it."""
        row, h = shingle_hashes(self.row, self.hash, window)
        if not len(row):
            return np.zeros(self.rows, np.int64)
        at = np.flatnonzero(self.row[: len(self.row) - window + 1] == self.row[window - 1 :])
        order = np.lexsort((h, row))
        same = (row[order][1:] == row[order][:-1]) & (h[order][1:] == h[order][:-1])
        twice = np.zeros(len(row), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(self.row) + 1, np.int64)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + window, -1)
        covered = np.cumsum(edge[:-1]) > 0
        return np.bincount(self.row[covered], minlength=self.rows)

    def distinct_words(self) -> np.ndarray:
        order = np.lexsort((self.hash, self.row))
        r, h = self.row[order], self.hash[order]
        new = np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])] if len(r) else np.zeros(0, bool)
        return np.bincount(r[new], minlength=self.rows)

    def after_itself(self) -> np.ndarray:
        """Per word: equals the word before it in its text."""
        out = np.zeros(len(self.row), bool)
        out[1:] = (self.hash[1:] == self.hash[:-1]) & (self.row[1:] == self.row[:-1])
        return out
