"""Byte-pair encoding and decoding by a deterministic tokenization automaton.

The automaton reads tokens: its states say which token was last, and an arc exists only where two tokens may stand side by
side in a correct encoding. It starts with one state that has an arc for every single letter, and each merge u + v -> w, in
order, adds its gadget: after u a copy of the state without the arc v is entered (a cut), and wherever u could be followed by
v an arc w leads to the state that v led to. All arcs of a token lead to one state at any time, so a state is known by its
token and the number of merges applied when it was entered, and the table of arcs is the cuts together with, for each token,
its parts and the merge that made it. Rows of the table are unfolded when first used and kept within a bound.

A pre-split word is encoded by walking the arcs over its letters, longest first: exactly one path spells each prefix, so a place
from which the walk had to return is never entered again. Decoding emits the labels (bytes) of the arcs. Time is linear in the word's length.

Defined cases: a null text is encoded like an empty one; marks of added tokens inside a text become their ids, as in the
library's default; rows are kept one by one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from larkframe.llm.registry import query, table
from larkframe.llm.tokens import ByteLevelEncoder, byte_letters, description_of

UNFOLDED = 1 << 21  # arcs kept


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocab.values()) + 1
        self.left, self.right, self.born = [-1] * size, [-1] * size, [-1] * size
        self.cut: dict[int, int] = {}  # u << 32 | v -> number of the merge
        self.rows: dict[int, dict[int, bool]] = {}
        self.unfolded = 0
        self.live = {t for text, t in vocab.items() if len(text) == 1}
        self.arcs: list = [-1, {}]  # token spelled so far, and the node after each letter
        for text, token in vocab.items():
            if len(text) == 1:
                self._spell(text, token)
        for number, (a, b) in enumerate(merges):
            self._gadget(number, vocab[a], vocab[b], vocab[a + b], a + b)

    def _spell(self, text: str, token: int) -> None:
        node = self.arcs
        for c in text:
            node = node[1].setdefault(c, [-1, {}])
        node[0] = token

    def _gadget(self, number: int, u: int, v: int, w: int, text: str) -> None:
        if self.born[w] >= 0:
            raise ValueError("two merges make one token")
        if u not in self.live or v not in self.live or not self.allowed(u, v, number - 1):
            return  # u is never followed by v here, so w is never made
        self.live.add(w)
        self.left[w], self.right[w], self.born[w] = u, v, number
        self.cut[u << 32 | v] = number
        self._spell(text, w)

    def allowed(self, u: int, t: int, time: int) -> bool:
        """Whether the state entered by u, after the merges up to ``time``, has an arc t."""
        left, right, born, cut = self.left, self.right, self.born, self.cut
        while True:
            number = cut.get(u << 32 | t)
            if number is not None and number <= time:
                return False
            if born[u] < 0 and born[t] < 0:
                return True
            if born[t] >= born[u]:  # the arc t was added where there was an arc of its first part
                time, t = born[t], left[t]
            else:  # the state after u was the one after its second part
                time, u = born[u] - 1, right[u]

    def follows(self, u: int, t: int) -> bool:
        row = self.rows.get(u)
        if row is None:
            row = self.rows[u] = {}
        ok = row.get(t)
        if ok is None:
            if self.unfolded >= UNFOLDED:
                self.rows, self.unfolded = {}, 0
                row = self.rows[u] = {}
            ok = row[t] = self.allowed(u, t, len(self.cut) + (1 << 40))
            self.unfolded += 1
        return ok

    def encode(self, word: str) -> list[int]:
        """Ids of a word, longest arc first. A place that was left without success is closed: only one path leads to it."""
        n, follows, start = len(word), self.follows, self.arcs
        if not n:
            return []
        path: list[int] = []
        waiting: list[tuple[int, list[tuple[int, int]]]] = []
        closed: set[int] = set()
        at, u = 0, -1
        while True:
            ways, node = [], start
            for j in range(at, n):
                node = node[1].get(word[j])
                if node is None:
                    break
                if node[0] >= 0:
                    ways.append((node[0], j + 1))
            while True:
                while ways:
                    t, j = ways.pop()
                    if j not in closed and (u < 0 or follows(u, t)):
                        break
                else:
                    if not path:
                        raise ValueError("a letter without a token")
                    closed.add(at)
                    path.pop()
                    at, ways = waiting.pop()
                    u = path[-1] if path else -1
                    continue
                break
            path.append(t)
            if j == n:
                return path
            waiting.append((at, ways))
            at, u = j, t


def automaton_of(description: str) -> tuple[Automaton, list[bytes | None]]:
    """The automaton of a tokenizer file, and the label of every id."""
    file = json.loads(description)
    model = file["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or file.get("normalizer"):
        raise ValueError("not a plain byte-level BPE file")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    value = {c: b for b, c in enumerate(byte_letters())}
    labels: list[bytes | None] = [None] * (1 + max([*model["vocab"].values(), *(t["id"] for t in file["added_tokens"])]))
    for text, token in model["vocab"].items():
        labels[token] = bytes(value[c] for c in text) if all(c in value for c in text) else text.encode("utf-8")
    for t in file["added_tokens"]:
        labels[t["id"]] = t["content"].encode("utf-8")
    return Automaton(model["vocab"], merges), labels


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit numbers."""
    description = description_of(path)

    def run(batches):
        encoder = ByteLevelEncoder(description, automaton_of(description)[0].encode)
        for batch in batches:
            ids = [encoder.encode(t if isinstance(t, str) else "") for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, ids binary")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids)."""
    description = description_of(path)

    def run(batches):
        label = automaton_of(description)[1]
        for batch in batches:
            text = [b"".join(map(label.__getitem__, np.frombuffer(x, "<u4").tolist())).decode("utf-8", "replace") for x in batch["ids"]]
            yield batch.assign(text=text)

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, ids binary, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, of which only digests leave the task."""
    description = description_of(path)

    def run(batches):
        machine, label = automaton_of(description)
        encoder = ByteLevelEncoder(description, machine.encode)
        number = [str(i) for i in range(len(label))]
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = np.frombuffer(encoder.encode(text if isinstance(text, str) else ""), "<u4").tolist()
                decoded = b"".join(map(label.__getitem__, ids)).decode("utf-8", "replace").encode("utf-8")
                listed = ",".join(map(number.__getitem__, ids)).encode("ascii")
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op10_bpe_automaton")
def op10(spark, sf_dir):
    import public_tokenizers

    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
