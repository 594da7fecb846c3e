"""Language identification by cross-parsing.

For each language a suffix automaton accepts every substring of a bounded sample of labelled text. A
text is parsed greedily into the longest phrases the automaton accepts; the language that needs the
fewest phrases, weighed by the logarithm of its sample's length, wins.

Only the sample and the automata pass through the driver, and their size is set by ``SAMPLE_CHARS``
and ``TOTAL_CHARS``, not by the corpus. Tasks parse whole texts: blocks of all texts of a batch and all
languages advance together, one character a step, in numpy. Cutting a text into blocks adds at most
one phrase a block to each language alike.

Cases: null text, or text without a letter, is ``und`` with score 0. Without learned languages every
text is ``und``. Equal costs go to the language first in alphabetical order, with score 0. Rows with
the same number are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from accesstally.llm.text import fold, held_out
from accesstally.llm.workers import importable, released

#: Characters of labelled text learned for a language, and for all languages together.
SAMPLE_CHARS, TOTAL_CHARS = 24_000, 400_000
#: Labelled rows considered for a language, and the longest text or piece of one that is taken.
SAMPLE_ROWS, LONGEST = 400, 2_000
#: Characters of a block, and texts that are parsed together.
BLOCK, BATCH = 1024, 1000

SPACE = 1  # class of everything but letters; 0 is a letter no sample has


def learn(documents: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, str]:
    """Sample text of each language, from labelled rows outside the held-out fold.

    The rows with the smallest hashes are taken, whole where they have at most ``LONGEST`` characters, so the
    sample does not depend on how the table is stored. A count by language first says which hashes are small.
    Where those do not fill a language's sample, pieces of the longer ones follow, each from a letter at a
    hashed place on. A language without a letter in all these rows gives a piece of its first row with one.
    """
    rows = documents.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    rows = rows.filter((fold(F.col("doc_id")) != 1) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    # the text is hashed as well, or all rows that share a number would be taken together
    at, size, lettered = F.xxhash64("doc_id", "text"), F.char_length("text"), F.col("text").rlike(r"\p{L}")

    def below(names):
        """The hashes below a bound that leaves about four times as many rows of a language as are taken."""
        found = F.lit(False)
        for name in names:
            bound = -(2**63) + int(2**64 * min(1.0, 4 * SAMPLE_ROWS / counts[name])) - 1
            found |= (F.col("lang") == name) & (at <= bound)
        return found

    rest = F.substr("text", F.lit(1) + F.pmod(F.xxhash64("doc_id", F.lit(1)), size).cast("int"))
    rest = F.when(rest.rlike(r"\p{L}"), rest).otherwise(F.col("text"))
    piece = F.substr(F.regexp_replace(rest, r"^\P{L}++", ""), F.lit(1), F.lit(LONGEST))
    texts: dict[str, list[str]] = {}

    def more(found):
        by_name: dict[str, list[str]] = {}
        for row in sorted(found, key=lambda r: (r["at"], r["text"])):
            by_name.setdefault(row["lang"], []).append(row["text"])
        for name, bodies in by_name.items():
            texts.setdefault(name, []).extend(bodies[:SAMPLE_ROWS])

    most = min(SAMPLE_CHARS, TOTAL_CHARS // max(1, len(counts)))
    more(rows.filter(below(counts) & size.between(1, LONGEST) & lettered).select("lang", "text", at.alias("at")).distinct().collect())
    lacking = sorted(name for name in counts if sum(map(len, texts.get(name, []))) < most - LONGEST)
    if lacking:
        more(rows.filter(below(lacking) & (size > LONGEST) & lettered).select("lang", piece.alias("text"), at.alias("at")).distinct().collect())
    missing = sorted(set(counts) - set(texts))
    if missing:
        first = F.min(F.struct(at.alias("at"), piece.alias("text"))).alias("first")
        more(rows.filter(F.col("lang").isin(missing) & lettered).groupBy("lang").agg(first).select("lang", "first.*").collect())
    sample = {}
    for name in sorted(texts):
        taken, length = [], 0
        for body in texts[name]:
            if length + len(body) < most:
                taken.append(body)
                length += len(body)
        if not taken:
            body = texts[name][0]
            taken.append(body[next((i for i, c in enumerate(body) if c.isalpha()), 0) :][: max(1, most)])
        sample[name] = "\n".join(taken)
    return {name: s for name, s in sample.items() if any(c.isalpha() for c in s)}


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(alphabet: np.ndarray) -> np.ndarray:
    """The class of each code point: 0 a letter outside the alphabet, 1 no letter, else 2 and up."""
    kind = np.uint16 if len(alphabet) < 2**16 - 2 else np.uint32
    table = np.fromiter((0 if chr(c).isalpha() else SPACE for c in range(0x110000)), kind, 0x110000)
    table[alphabet] = np.arange(2, 2 + len(alphabet))
    return table


def squeezed(classes: np.ndarray) -> np.ndarray:
    """Runs of other than letters as one; none at the start."""
    space = classes == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    if len(keep):
        keep[0] = not space[0]
    return classes[keep]


def automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton by state; state 0 is the root. There are at most three for each class of the sequence."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for c in sequence:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                split = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = split
                    p = link[p]
                link[q] = link[new] = split
        last = new
    return step


#: Places of the table of transitions for each of them, at least; and an odd number that spreads keys.
ROOM, SPREAD = 3, 0x9E3779B97F4A7C15


class Transitions:
    """Transitions of all automata in one hash table, as large as there are transitions, whatever the alphabet.

    A key is a state and a class in one number. A key that finds its place taken has the next free one.
    """

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        bits = max(4, int(ROOM * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at = self._places(keys)
        while len(keys):
            free = np.flatnonzero(self.keys.take(at) < 0)
            places, first = np.unique(at[free], return_index=True)
            self.keys[places], self.to[places] = keys[free[first]], to[free[first]]
            left = np.ones(len(keys), bool)
            left[free[first]] = False
            keys, to, at = keys[left], to[left], (at[left] + 1) & self.mask

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(SPREAD)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The state that each key leads to, or -1."""
        at = self._places(keys)
        held = self.keys.take(at)
        hit = held == keys
        found = np.where(hit, self.to.take(at), np.int32(-1))
        rest = np.flatnonzero(~hit & (held >= 0))
        at = at.take(rest)
        while len(rest):
            at = (at + 1) & self.mask
            held = self.keys.take(at)
            hit = held == keys.take(rest)
            found[rest[hit]] = self.to.take(at[hit])
            on = ~hit & (held >= 0)
            rest, at = rest[on], at[on]
        return found


class Model:
    """All languages' automata with one table of transitions; states are numbered through all of them."""

    def __init__(self, sample: dict[str, str]):
        self.langs = sorted(sample)
        letters = np.unique(codes("".join(sample.values())))
        letters = np.array([c for c in letters if chr(c).isalpha()], np.uint32)
        self.alphabet, self.width = letters, len(letters) + 2
        table = classes_of(letters)
        self.weight, offset = [], 0
        self.first = np.full((len(self.langs), self.width), -1, np.int64)  # the step from each root
        self.roots = np.zeros(len(self.langs), np.int64)
        keys, targets = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for j, name in enumerate(self.langs):
            learned = squeezed(table[codes(sample[name])]).tolist()
            moves = automaton(learned)
            self.roots[j] = offset
            for c, to in moves[0].items():
                self.first[j, c] = to + offset
            edges = [((state + offset) * self.width + c, to + offset) for state, out in enumerate(moves) for c, to in out.items()]
            keys.append(np.fromiter((k for k, _ in edges), np.int64, len(edges)))
            targets.append(np.fromiter((t for _, t in edges), np.int32, len(edges)))
            self.weight.append(np.log2(max(2, len(learned))))
            offset += len(moves)
        self.moves = Transitions(np.concatenate(keys), np.concatenate(targets))

    def table(self) -> np.ndarray:
        """Classes of all code points, made once in a worker."""
        if not hasattr(self, "_table"):
            self._table = classes_of(self.alphabet)
        return self._table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def phrases(self, lanes: list[np.ndarray]) -> np.ndarray:
        """Phrases each lane needs in each language, [language, lane]."""
        order = sorted(range(len(lanes)), key=lambda i: -len(lanes[i]))
        sizes = np.array([len(lanes[i]) for i in order])
        steps = np.zeros((int(sizes.max(initial=0)), len(lanes)), lanes[0].dtype if lanes else np.uint16)
        for k, i in enumerate(order):
            steps[: len(lanes[i]), k] = lanes[i]
        roots = self.roots[:, None]
        unseen = self.first < 0
        first = np.where(unseen, roots, self.first)
        state = np.repeat(roots, len(lanes), axis=1)
        count = np.zeros((len(self.langs), len(lanes)), np.int32)
        active = np.searchsorted(-sizes, -np.arange(len(steps)), side="left")
        for t, row in enumerate(steps):
            n = active[t]
            c = row[:n]
            to = self.moves.find((state[:, :n] * self.width + c).ravel()).reshape(-1, n)
            missed = to < 0
            count[:, :n] += missed & (state[:, :n] != roots)  # at the root no phrase has begun
            state[:, :n] = np.where(missed, first.take(c, axis=1), to)
        for j in range(len(self.langs)):
            if unseen[j].any():
                # the padding beyond a lane is class 0, which counts as unseen: take it off again
                per = unseen[j].take(steps).sum(axis=0) - (len(steps) - sizes) * unseen[j][0]
                count[j] += per
        result = np.empty_like(count)
        result[:, order] = count + (state != roots)
        return result

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lanes, owner = [], []
        table = self.table()
        for i, text in enumerate(texts):
            if not text or not self.langs:
                continue
            sequence = table[codes(text)]
            if not (sequence != SPACE).any():
                continue
            sequence = squeezed(sequence)
            for at in range(0, len(sequence), BLOCK):
                lanes.append(sequence[at : at + BLOCK])
                owner.append(i)
        cost = np.zeros((len(self.langs), len(texts)))
        if lanes:
            counted = self.phrases(lanes)
            for j in range(len(self.langs)):
                cost[j] = np.bincount(owner, counted[j] * self.weight[j], len(texts))
        names, scores = [], []
        for i in range(len(texts)):
            each = cost[:, i]
            if not len(each) or each[0] == 0:
                names.append("und")
                scores.append(0.0)
                continue
            best = int(each.argmin())
            rest = np.delete(each, best)
            names.append(self.langs[best])
            scores.append(float(1 - each[best] / rest.min()) if len(rest) else 1.0)
        return names, scores


def identify(documents: DataFrame, sample: dict[str, str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred and score of every row, from its text alone."""
    spark = importable(documents.sparkSession)
    model = spark.sparkContext.broadcast(Model(sample))
    out = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def judged(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                names, scores = model.value.judge(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=out)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(released(judged), "doc_id long, lang_pred string, score double")


def keep_known(documents: DataFrame, sample: dict[str, str], text: str = "text") -> DataFrame:
    """The rows whose text is in a learned language (not ``und``), with all their columns."""
    model = importable(documents.sparkSession).sparkContext.broadcast(Model(sample))
    at = documents.columns.index(text)

    def kept(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                names, _ = model.value.judge(part.column(at).to_pylist())
                yield part.filter(pa.array([n != "und" for n in names], pa.bool_()))

    return documents.mapInArrow(released(kept), documents.schema)


def op10_language(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(documents, learn(documents))
    return found.withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")
