"""Toxicity of documents by a weighted finite-state pattern grammar.

A text is a row of clauses (cut at . ! ? ; : and line ends), a clause a row of symbols:
insults, threats, targets (whom it is said to), negations, reporting verbs, quotation marks and
other words. Insults come from a weighted acceptor of words and word beginnings,
threats, targets, negations and reporting verbs from word lists. Small transducers mark a
hit that follows a negation, stands in reported speech or has a target beside it; they are
composed into one table, which runs over all matched clauses of a batch at once. The
weights along a clause's path add up; a word alone, outside its clause, scores nothing.

Training: the acceptor's entries are taken greedily from words and beginnings that
documents labelled toxic have and others do not, each document counting half as much for every
entry that it already has. A logistic fit turns a document's clause weights into a
score. Both read at most about ``MAX_FIT`` labelled rows, chosen by a hash of the id;
nothing is taken from ``lang``, ``source`` or ``doc_id``. The model holds at most ``MAX_ENTRIES``
entries and is broadcast.

Edge cases: a null, empty or word-less text has no clause and scores like any text
without a match. Texts are taken whole. A document with several label rows is toxic
if one of them says so; null labels are not learned from. Without toxic or without
clean labels the fixed lists and weights stand. Equal rows are rows, and one text of each
id is learned from; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.llm.common import KeyTable, SpanHash, filled, mix, small_batches, stored
from thermogrid.llm.lang_id import SPACE, fold, held_out, steps

# ---- fixed values: word lists of the grammar (en, de, fr, es)
INSULTS = ("idiot idiots moron morons stupid dumb scum trash garbage loser losers clown worthless pathetic disgusting "
           "imbecile fool jerk bastard pig vermin parasite filth freak coward liar retard "
           "dumm idiotisch trottel depp abschaum versager widerlich arschloch schwein "
           "imbécile crétin abruti ordure minable connard salaud dégoûtant "
           "imbécil estúpido estúpida basura escoria perdedor inútil cerdo asqueroso").split()
THREATS = ("kill hurt destroy burn beat shoot stab punish crush hang murder "
           "töten umbringen vernichten schlagen verbrennen tuer détruire brûler frapper matar destruir quemar golpear").split()
TARGETS = ("you your yours yourself u he him she her they them their these those this that people everyone "
           "du dich dir dein ihr euch euer sie diese dieser ihn tu toi ton vous votre vos ils elles ce cette ces "
           "usted ustedes te ti vosotros ellos ellas este esta estos ese esa").split()
NEGATIONS = ("not no never neither nor without isn aren wasn don doesn didn cannot hardly "
             "nicht kein keine keinen nie niemals ohne ne pas jamais aucun sans nunca jamás sin tampoco").split()
REPORTS = ("said says say called calls wrote writes claimed claims quoted reported told asked "
           "sagte sagt schrieb behauptete nannte dit disait écrit appelé dijo dice escribió llamó").split()
# ---- end of the fixed values

MAX_FIT = 24_000       # labelled rows that the model is fitted on, about
MAX_TERMS = 200_000    # words and beginnings compared between toxic and other rows
MAX_ENTRIES = 4_000    # learned entries of the acceptor
SUPPORT = 3            # toxic documents that an entry needs
BEGINNINGS = (4, 5, 6, 7, 8)  # code points of a word's beginning
WHOLE = 0
NEAR = 3               # words within which a negation or a target belongs to a hit
RIDGE = 0.05

# symbols of the tape, and marks that the transducers add to them
OTHER, INSULT, THREAT, TARGET, NEG, REPORT, QUOTE, LATE = range(8)
NEGATED, REPORTED, AIMED = 8, 16, 32
SYMBOLS = 64
CLAUSE_END = ".!?;:\n\r"
QUOTES = "\"“”„«»"


# ------------------------------------------------------------------ transducers

@dataclass
class Transducer:
    """Deterministic: ``to[state, symbol]`` and ``out[state, symbol]``; starts in 0."""

    to: np.ndarray
    out: np.ndarray

    def then(self, other: "Transducer") -> "Transducer":
        """The composition: ``other`` reads what this one writes."""
        n, m = self.to.shape[0], other.to.shape[0]
        a, b = np.repeat(np.arange(n), m), np.tile(np.arange(m), n)
        middle = self.out[a]
        return Transducer(self.to[a] * m + other.to[b[:, None], middle], other.out[b[:, None], middle])


def _machine(states: int, step) -> Transducer:
    """``step(state, base symbol, symbol)`` gives the next state and the written symbol."""
    to, out = np.zeros((states, SYMBOLS), np.int64), np.zeros((states, SYMBOLS), np.int64)
    for s in range(states):
        for x in range(SYMBOLS):
            to[s, x], out[s, x] = step(s, x & 7, x)
    return Transducer(to, out)


def _negation(s, base, x):
    """A hit within ``NEAR`` words behind a negation is negated."""
    if base == NEG:
        return 1, x
    if base == QUOTE:
        return s, x
    return (s + 1 if 0 < s < NEAR else 0), (x | NEGATED if s and base in (INSULT, THREAT) else x)


def _reported(s, base, x):
    """A hit behind a reporting verb, or between quotation marks, is reported."""
    verb, inside = s & 1, s & 2
    if base == REPORT:
        verb = 1
    if base == QUOTE:
        inside ^= 2
    return verb | inside, (x | REPORTED if s and base in (INSULT, THREAT) else x)


def _aimed(s, base, x):
    """A hit within ``NEAR`` words behind a target is aimed; a target within ``NEAR`` words
    behind a hit is written as ``LATE``. State: words since the target x words since the hit."""
    since_target, since_hit = divmod(s, NEAR + 1)
    out = x
    if base in (INSULT, THREAT) and since_target:
        out |= AIMED
    if base == TARGET and since_hit:
        out = LATE | (x & ~7)
    later = lambda t: t + 1 if 0 < t < NEAR else 0
    if base != QUOTE:
        since_target, since_hit = later(since_target), later(since_hit)
    if base == TARGET:
        since_target = 1
    if base in (INSULT, THREAT):
        since_hit = 1
    return since_target * (NEAR + 1) + since_hit, out


GRAMMAR = (_machine(NEAR + 1, _negation).then(_machine(4, _reported))
           .then(_machine((NEAR + 1) ** 2, _aimed)))
# Words without a part in the grammar move no state after this many of them.
SETTLED = NEAR + 1


def _weights() -> np.ndarray:
    """Weight of each written symbol: an aimed hit counts more, a negated or reported one
    less; a threat counts only if it is aimed."""
    w = np.zeros(SYMBOLS)
    for x in range(SYMBOLS):
        if x & 7 in (INSULT, THREAT, LATE):
            w[x] = {INSULT: 1.0, THREAT: 0.0, LATE: 0.25}[x & 7]
            if x & AIMED:
                w[x] += 0.5
            if x & NEGATED:
                w[x] *= 0.4
            if x & REPORTED:
                w[x] *= 0.5
    return w


ARC = _weights()


# ------------------------------------------------------------------ tape

class PointHash(SpanHash):
    """:class:`SpanHash` over code points."""

    def prefix(self, points: np.ndarray) -> np.ndarray:
        self._grow(points.size + 1)
        out = np.zeros(points.size + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((mix(points.astype(np.uint64) + np.uint64(7)) | np.uint64(1)) * self.pow[:points.size], out=out[1:])
        return out


_HASH = PointHash(121)
_MARKS: list[np.ndarray] = []


def _marks() -> np.ndarray:
    """Code point -> 1 for the end of a clause, 2 for a quotation mark, else 0."""
    if not _MARKS:
        t = np.zeros(0x110000, np.int8)
        t[[ord(c) for c in CLAUSE_END]] = 1
        t[[ord(c) for c in QUOTES]] = 2
        _MARKS.append(t)
    return _MARKS[0]


def _hash(word: str) -> int:
    x = np.array([ord(c) for c in word], np.uint32)
    return int(_HASH.spans(_HASH.prefix(x), np.zeros(1, np.int64), np.array([x.size]))[0])


class Tape:
    """Tokens (words and quotation marks) of some texts, with their clause, text and place."""

    def __init__(self, texts: list[str]):
        n = len(texts)
        lens = np.fromiter((len(t) + 1 for t in texts), np.int64, n)
        points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32) if n else \
            np.zeros(0, np.uint32)
        self.points = fold()[points]
        marks = _marks()[points]
        letter = self.points != SPACE
        start = letter.copy()
        start[1:] &= ~letter[:-1]
        last = letter.copy()
        last[:-1] &= ~letter[1:]
        quote = marks == 2
        self.start = np.flatnonzero(start | quote)
        self.end = np.flatnonzero(last | quote) + 1
        self.quote = quote[self.start]
        self.clause = np.cumsum(marks == 1)[self.start] if n else np.zeros(0, np.int64)
        self.text_start = np.cumsum(lens) - lens
        self.of = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.prefix = _HASH.prefix(self.points)

    def hashes(self, which: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the tokens ``which`` those long enough, with the hash of their first
        ``length`` code points (``WHOLE``: of all)."""
        which = which[~self.quote[which]]
        if length == WHOLE:
            return which, _HASH.spans(self.prefix, self.start[which], self.end[which])
        which = which[self.end[which] - self.start[which] >= length]
        return which, _HASH.spans(self.prefix, self.start[which], self.start[which] + length)


def _lookup(tape: Tape, which: np.ndarray, tables: dict[int, KeyTable], missing: int) -> np.ndarray:
    """Largest value of the tables' entries that each token has."""
    out = np.full(which.size, missing, np.int32)
    place = np.full(tape.start.size, -1, np.int64)
    place[which] = np.arange(which.size)
    for length, table in tables.items():
        some, h = tape.hashes(which, length)
        at = place[some]
        out[at] = np.maximum(out[at], table.get(h, missing))
    return out


def _tables(entries: dict[tuple[int, int], int]) -> dict[int, KeyTable]:
    """(length, hash) -> value as one table per length."""
    out = {}
    for length in sorted({k for k, _ in entries}):
        keys = [(h, v) for (k, h), v in entries.items() if k == length]
        out[length] = KeyTable(np.array([h for h, _ in keys], np.uint64), np.array([v for _, v in keys]))
    return out


# ------------------------------------------------------------------ model

FEATURES = 5


@dataclass
class Model:
    """``entries``: (text, whole word or beginning, weight) of the insult acceptor;
    ``beta`` weighs the document features, constant last."""

    entries: list[tuple[str, bool, float]]
    beta: np.ndarray = field(default_factory=lambda: np.array([1.5, 1.0, 0.5, -0.5, 1.0, -2.5]))

    def __post_init__(self):
        # weights as thousandths; a token takes the heaviest entry that it has
        self.insults = _tables({(WHOLE if whole else len(t), _hash(t)): int(1000 * w) for t, whole, w in self.entries})
        words = {}
        for kind, group in ((THREAT, THREATS), (TARGET, TARGETS), (NEG, NEGATIONS), (REPORT, REPORTS)):
            words.update({(WHOLE, _hash(w)): kind for w in group})
        self.words = _tables(words)
        self.threats = _tables({(WHOLE, _hash(w)): THREAT for w in THREATS})

    def clauses(self, texts: list[str]):
        """Matched clauses of the texts: text, first and last code point, weight of the
        path, weight of its negated and reported part, aimed threats."""
        tape = Tape(texts)
        every = np.arange(tape.start.size)
        weight = _lookup(tape, every, self.insults, 0)
        hit = (weight > 0) | (_lookup(tape, every, self.threats, 0) > 0)
        matched = np.unique(tape.clause[hit])
        if not matched.size:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0),) * 3
        mine = every[np.isin(tape.clause, matched)]
        symbol = _lookup(tape, mine, self.words, OTHER).astype(np.int64)
        symbol[weight[mine] > 0] = INSULT
        symbol[tape.quote[mine]] = QUOTE
        clause = np.searchsorted(matched, tape.clause[mine])
        first, last = np.searchsorted(clause, np.arange(matched.size)), np.searchsorted(clause, np.arange(matched.size), "right") - 1
        # long stretches of other words change nothing after SETTLED of them
        other = symbol == OTHER
        run = np.arange(mine.size) - np.maximum.accumulate(np.where(~other, np.arange(mine.size), -1))
        inside = np.arange(mine.size) - first[clause]
        keep = ~other | (np.minimum(run, inside + 1) <= SETTLED)
        wrote = self._run(symbol[keep], clause[keep], matched.size)
        gain = ARC[wrote] * np.where(wrote & 7 == INSULT, weight[mine][keep] / 1000.0, 1.0)
        soft = (wrote & (NEGATED | REPORTED)) > 0
        total = np.bincount(clause[keep], gain, matched.size)
        softened = np.bincount(clause[keep], gain * soft, matched.size)
        threats = np.bincount(clause[keep], (wrote & 7 == THREAT) & (wrote & AIMED > 0) & ~soft, matched.size)
        some = total > 0
        of = tape.of[mine[first]]
        base = tape.text_start[of]
        return (of[some], (tape.start[mine[first]] - base)[some], (tape.end[mine[last]] - base)[some],
                total[some], softened[some], threats[some])

    @staticmethod
    def _run(symbol: np.ndarray, clause: np.ndarray, n: int) -> np.ndarray:
        """The grammar over all clauses together, one symbol per step; longest first, so
        that those still running are a prefix."""
        size = np.bincount(clause, minlength=n)
        begin = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        running = np.searchsorted(-size[order], -np.arange(size.max()), side="left")
        state = np.zeros(n, np.int64)
        out = np.empty(symbol.size, np.int64)
        for i, k in enumerate(running.tolist()):
            at = begin[order[:k]] + i
            x = symbol[at]
            out[at] = GRAMMAR.out[state[:k], x]
            state[:k] = GRAMMAR.to[state[:k], x]
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: clause weights summed (log), the heaviest clause, number of matched clauses
        (log), the negated and reported part (log), aimed threats (log)."""
        out = np.zeros((len(texts), FEATURES))
        for i, part in steps(texts):
            of, _, _, total, soft, threats = self.clauses(part)
            n = len(part)
            x = out[i:i + n]
            x[:, 0] = np.log1p(np.bincount(of, total, n))
            np.maximum.at(x[:, 1], of, np.minimum(total, 4.0))
            x[:, 2] = np.log1p(np.bincount(of, minlength=n))
            x[:, 3] = np.log1p(np.bincount(of, soft, n))
            x[:, 4] = np.log1p(np.bincount(of, threats, n))
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        z = self.features(texts) @ self.beta[:-1] + self.beta[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


# ------------------------------------------------------------------ training

def _terms(texts: list[str]):
    """Distinct (text, length, hash) of all words and beginnings, with a token that has it."""
    for i, part in steps(texts):
        tape = Tape(part)
        every = np.arange(tape.start.size)
        for length in (WHOLE, *BEGINNINGS):
            some, h = tape.hashes(every, length)
            if length == WHOLE:
                long = tape.end[some] - tape.start[some] >= 3
                some, h = some[long], h[long]
            if not some.size:
                continue
            order = np.lexsort((h, tape.of[some]))
            new = np.ones(order.size, bool)
            new[1:] = (h[order][1:] != h[order][:-1]) | (tape.of[some][order][1:] != tape.of[some][order][:-1])
            pick = order[new]
            yield i, length, tape, some[pick], h[pick]


def _term_counts(rows: DataFrame, known: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(length, hash, n): texts of ``rows`` (text) that have each term; only the terms ``known``."""
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for _, length, _, _, h in _terms(filled(batch.column(0)).to_pylist()):
                if known is not None:
                    h = h[np.isin(h, known.get(length, np.zeros(0, np.uint64)))]
                u, c = np.unique(h, return_counts=True)
                held.setdefault(length, []).append((u, c))
            for length, parts in held.items():
                if len(parts) > 16:
                    held[length] = [_added(parts)]
        for length, parts in held.items():
            u, c = _added(parts)
            for i in range(0, u.size, 1 << 16):
                s = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(u[s].size, length, np.int32)), pa.array(u[s].view(np.int64)),
                                                  pa.array(c[s].astype(np.int64))], names=["length", "hash", "n"])

    return (rows.select("text").mapInArrow(run, "length int, hash long, n long")
            .groupBy("length", "hash").agg(F.sum("n").alias("n")))


def _added(parts):
    u, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return u, np.bincount(at, np.concatenate([p[1] for p in parts]).astype(np.float64), u.size).astype(np.int64)


def _by_length(table: pa.Table) -> dict[int, np.ndarray]:
    length, h = table.column("length").to_numpy(), table.column("hash").to_numpy().view(np.uint64)
    return {k: np.sort(h[length == k]) for k in np.unique(length).tolist()}


def _holders(toxic: DataFrame, known: dict[int, np.ndarray]) -> pa.Table:
    """(doc, length, hash, term): which toxic rows (row, text) have which of the terms."""
    def run(batches):
        for batch in batches:
            ident = batch.column(0).to_numpy()
            for i, length, tape, token, h in _terms(filled(batch.column(1)).to_pylist()):
                keep = np.isin(h, known.get(length, np.zeros(0, np.uint64)))
                token, h = token[keep], h[keep]
                end = tape.end[token] if length == WHOLE else tape.start[token] + length
                terms = ["".join(map(chr, tape.points[a:b].tolist())) for a, b in zip(tape.start[token], end)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ident[i + tape.of[token]]), pa.array(np.full(h.size, length, np.int32)), pa.array(h.view(np.int64)),
                     pa.array(terms, pa.string())], names=["doc", "length", "hash", "term"])

    return toxic.select("row", "text").mapInArrow(run, "doc long, length int, hash long, term string").toArrow()


def _chosen(held: pa.Table, clean: dict[tuple[int, int], int], n_toxic: int, n_clean: int) -> list[tuple[str, bool, float]]:
    """Greedy choice of entries: the one that the toxic documents of most weight have and
    clean ones do not; a document's weight halves with each entry that it gets."""
    if not held.num_rows:
        return []
    length, h = held.column("length").to_numpy(), held.column("hash").to_numpy()
    _, doc = np.unique(held.column("doc").to_numpy(), return_inverse=True)
    keys, first, of = np.unique(np.stack([length.astype(np.int64), h], axis=1), axis=0, return_index=True, return_inverse=True)
    of = of.ravel()
    names = held.column("term").take(pa.array(first)).to_pylist()
    toxic_n = np.bincount(of, minlength=len(keys)).astype(float)
    clean_n = np.array([clean.get((int(a), int(b)), 0) for a, b in keys.tolist()], float)
    odds = np.log((toxic_n + 0.5) / (n_toxic + 1)) - np.log((clean_n + 0.5) / (n_clean + 1))
    good = (odds > 2.0) & (toxic_n / (toxic_n + clean_n) > 0.75)
    chars = np.array([len(x) for x in names])
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(len(keys) + 1))
    weight = np.ones(doc.max() + 1)
    live, out = good.copy(), []
    enough = max(1.0, 0.0005 * n_toxic)
    while live.any() and len(out) < MAX_ENTRIES:
        gain = np.where(live, np.bincount(of, weight[doc], len(keys)) - clean_n, -1.0)
        best = int(np.lexsort((-chars, -np.round(gain, 6)))[0])
        if gain[best] < enough:
            break
        live[best] = False
        weight[doc[order[bounds[best]:bounds[best + 1]]]] *= 0.5
        out.append((names[best], bool(keys[best][0] == WHOLE), float(np.clip(odds[best] / 5.0, 0.2, 2.0))))
    return out


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant is not shrunk."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    shrink = np.full(a.shape[1], RIDGE)
    shrink[-1] = 1e-6
    beta = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((a * w[:, None]).T @ a + np.diag(shrink), a.T @ (y - p) - shrink * beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_fit: int = MAX_FIT) -> Model:
    """The model of the labelled rows of ``docs``, fitted on about ``max_fit`` of them."""
    small_batches(docs.sparkSession)
    fixed = [(w, True, 1.0) for w in INSULTS]
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).alias("y")))
    n = known.count()
    if n > max_fit:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * max_fit / n))
    # about max_fit rows: one text of each id
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id")
                  .groupBy("id").agg(F.max("text").alias("text"), F.max("y").alias("y"))
                  .select(F.monotonically_increasing_id().alias("row"), "text", (F.col("y") > 0).cast("double").alias("y")),
                  "labelled")
    sizes = {bool(r.y): r["count"] for r in rows.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Model(fixed)
    toxic, clean = rows.where("y = 1"), rows.where("y = 0")
    found = _term_counts(toxic).where(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "length", "hash").limit(MAX_TERMS).toArrow()
    other = _term_counts(clean, _by_length(found)).toArrow()
    n_of, clean_n = _as_dict(found), _as_dict(other)
    keep = [k for k, c in n_of.items() if c > 3 * clean_n.get(k, 0)]
    some = pa.table({"length": pa.array([k[0] for k in keep], pa.int32()), "hash": pa.array([k[1] for k in keep], pa.int64())})
    learned = _chosen(_holders(toxic, _by_length(some)), clean_n, sizes[True], sizes[False])
    have = {t for t, whole, _ in learned if whole}
    # a listed word keeps its weight unless the labels speak against it
    for w in INSULTS:
        key = (WHOLE, int(np.uint64(_hash(w)).view(np.int64)))
        if w not in have and clean_n.get(key, 0) <= n_of.get(key, 0) + 1:
            learned.append((w, True, 1.0))
    model = Model(learned)
    model.beta = _fit(*_feature_rows(rows, model))
    return model


def _as_dict(table: pa.Table) -> dict[tuple[int, int], int]:
    return dict(zip(zip(table.column("length").to_pylist(), table.column("hash").to_pylist()), table.column("n").to_pylist()))


def _feature_rows(rows: DataFrame, model: Model):
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"x{k}" for k in range(FEATURES)]

    def run(batches):
        for batch in batches:
            x = shared.value.features(filled(batch.column(0)).to_pylist())
            yield pa.RecordBatch.from_arrays([*[pa.array(x[:, k]) for k in range(FEATURES)], batch.column(1)], names=[*names, "y"])

    got = rows.select("text", "y").mapInArrow(run, ", ".join(f"{c} double" for c in [*names, "y"])).toArrow()
    return np.stack([got.column(c).to_numpy() for c in names], axis=1), got.column("y").to_numpy()


# ------------------------------------------------------------------ scoring

def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.score(filled(batch.column(1)).to_pylist()))], names=["doc_id", "score"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, score double").withColumnRenamed("doc_id", id_col)


CLAUSES = "clauses array<struct<start:int,end:int,weight:double>>"


def matched_clauses(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, clauses): the matched clauses of every row, as code points [start, end) with
    the weight of their path."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())])

    def run(batches):
        for batch in batches:
            texts = filled(batch.column(1)).to_pylist()
            found = [[] for _ in texts]
            for i, part in steps(texts):
                for of, a, b, w, _, _ in zip(*(v.tolist() for v in shared.value.clauses(part))):
                    found[i + of].append({"start": a, "end": b, "weight": w})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "clauses"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {CLAUSES}").withColumnRenamed("doc_id", id_col)


def op12_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out(5)), labels.where(~held_out(5)))
    return score(docs, model).select("doc_id", held_out(5).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
