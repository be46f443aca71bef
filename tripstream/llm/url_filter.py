"""URL filter: all glob rules at once, by a bit-parallel wildcard automaton.

Every rule is a glob over the *canonical URL*: host (A-Z lower-cased) + path
+ ``?query``; scheme and fragment are dropped, and a null or a text without
``://`` gives the empty canonical URL. Glob syntax:

* ``*``   any run of characters without ``/``
* ``**``  any run of characters
* ``\\x``  the character ``x`` itself

A glob has one state per literal plus one; the states of all globs are packed
side by side into 64-bit words. Reading a byte ``c`` is one Shift-And step

    D = ((D & step[c]) << 1) | (D & stay[c])

over those words, so all globs advance together. A batch runs position by
position over all its URLs (numpy, one row of words per URL); a few very long
URLs left over go on with the same masks as one Python integer each.

Decisions: a *site rule* (host + path prefix, allow or block) fits its host
and all subdomains; of those that fit, the longest wins. Without one the URL
is blocked when any *block glob* matches, else allowed.

Edge cases: null / no ``://`` -> host, path empty, verdict by the empty glob;
empty table -> no rows; repeated rows are judged one by one; other columns of
the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tripstream.llm.common import LOWER, UPPER

# The site rules of the query's contract.
SITE_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: What is blocked where no site rule fits: no URL at all, listings and
#: sessions, log-ins and administration, downloads, adult and gambling sites.
BLOCK_GLOBS = [
    "",
    "**\\?page=**",
    "**\\?**session**",
    "**/login**",
    "**/wp-admin/**",
    "**/cgi-bin/**",
    "**.exe",
    "**.zip",
    "*casino*/**",
    "*porn*/**",
]

#: URLs still unread in a batch below which they go on one by one.
FEW = 8


def parse_glob(glob: str) -> tuple[list[int], dict[int, bool]]:
    """Literal bytes, and which states loop: state -> also over ``/``."""
    literals: list[int] = []
    loops: dict[int, bool] = {}
    i = 0
    while i < len(glob):
        if glob[i] == "*":
            wide = glob.startswith("**", i)
            loops[len(literals)] = loops.get(len(literals), False) or wide
            i += 2 if wide else 1
            continue
        i += glob[i] == "\\"
        literals += glob[i].encode()
        i += 1
    return literals, loops


class GlobAutomaton:
    """Masks of all globs, as integers and as 64-bit words."""

    def __init__(self, globs: list[str]):
        step, stay = [0] * 256, [0] * 256
        self.start, self.accept, at = 0, [], 0
        for glob in globs:
            literals, loops = parse_glob(glob)
            self.start |= 1 << at
            for j, byte in enumerate(literals):
                step[byte] |= 1 << (at + j)
            for j, wide in loops.items():
                for byte in range(256):
                    if wide or byte != ord("/"):
                        stay[byte] |= 1 << (at + j)
            at += len(literals)
            self.accept.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.step, self.stay = step, stay
        self.step_words = np.array([self._split(x) for x in step], np.uint64)
        self.stay_words = np.array([self._split(x) for x in stay], np.uint64)

    def _split(self, mask: int) -> list[int]:
        return [(mask >> (64 * w)) & 0xFFFFFFFFFFFFFFFF for w in range(self.words)]

    def run(self, urls: list[bytes]) -> np.ndarray:
        """Which globs match each URL: a boolean array, URLs by globs."""
        n = len(urls)
        state = np.tile(np.array(self._split(self.start), np.uint64), (n, 1))
        lengths = np.fromiter(map(len, urls), np.int64, n)
        order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate(([0], np.cumsum(lengths)))
        text = np.frombuffer(b"".join(urls), np.uint8)
        rank = -lengths[order]
        i, live = 0, n
        while True:
            live = int(np.searchsorted(rank, -i, "left"))  # URLs longer than i
            if live < FEW:
                break
            rows = order[:live]
            c = text[starts[rows] + i]
            d = state[rows]
            moved = d & self.step_words[c]
            out = moved << np.uint64(1)
            if self.words > 1:
                out[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            state[rows] = out | (d & self.stay_words[c])
            i += 1
        for row in order[:live]:
            d = sum(int(w) << (64 * k) for k, w in enumerate(state[row]))
            for c in urls[row][i:]:
                d = ((d & self.step[c]) << 1) | (d & self.stay[c])
            state[row] = self._split(d)
        bits = np.array(self.accept, np.int64)
        return (state[:, bits // 64] >> (bits % 64).astype(np.uint64)) & np.uint64(1) == 1


def canonical_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path`` and ``canonical`` (JVM side)."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    return urls.withColumns({"host": host, "path": path, "canonical": F.concat(host, path, query)})


def escape_glob(text: str) -> str:
    return "".join("\\" + c if c in "*\\" else c for c in text)


def site_globs(rules: list[tuple[str, str, str]]) -> list[str]:
    """Two globs a rule: its host, and its subdomains."""
    tails = [escape_glob(host + path) + "**" for _, host, path in rules]
    return [g for t in tails for g in (t, "*." + t)]


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None,
               block_globs: list[str] | None = None, page_id: str = "page_id",
               url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, n_globs``, one row per input row."""
    rules = SITE_RULES if rules is None else rules
    block_globs = BLOCK_GLOBS if block_globs is None else block_globs
    n = len(rules)
    globs = site_globs(rules) + list(block_globs)
    # longest rule first, so that the first that fits wins
    by_length = sorted(range(n), key=lambda k: -len(rules[k][1] + rules[k][2]))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = GlobAutomaton(globs)
        names = np.array([rules[k][1] + rules[k][2] for k in by_length] + [None], object)
        acts = np.array([rules[k][0] for k in by_length] + [None], object)
        for pdf in batches:
            hits = auto.run([x.encode("utf-8", "surrogatepass") for x in pdf["canonical"]])
            # site rules are about host and path: without a path, "*" must not run on into the query
            bare = np.flatnonzero((pdf["path"] == "") & (pdf["canonical"] != pdf["host"]))
            if len(bare):
                hits[bare, :2 * n] = auto.run(
                    [x.encode("utf-8", "surrogatepass") for x in pdf["host"].iloc[bare]])[:, :2 * n]
            fits = (hits[:, 0:2 * n:2] | hits[:, 1:2 * n:2])[:, by_length]
            first = np.where(fits.any(axis=1), fits.argmax(axis=1), n) if n else np.zeros(len(pdf), int)
            blocked = hits[:, 2 * n:].sum(axis=1)
            verdict = np.where(first < n, acts[first], np.where(blocked > 0, "block", "allow"))
            yield pd.DataFrame({"page_id": pdf["page_id"], "host": pdf["host"], "path": pdf["path"],
                                "rule": names[first], "verdict": verdict, "n_globs": blocked})

    parts = canonical_parts(pages.select(F.col(page_id).cast("long").alias("page_id"),
                                         F.col(url).alias("url"))).drop("url")
    return parts.mapInPandas(judge, "page_id long, host string, path string, rule string, "
                                    "verdict string, n_globs long")
