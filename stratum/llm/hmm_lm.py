"""Language-model scores from a hidden Markov model over word classes.

A word's class is a hash of it; the model's latent states emit classes, and a
class emits its words in proportion to their counts in the training documents,
plus one for each and one for all unseen words. So every word of the corpus has
its own probability, while the states' tables have a fixed size.

Baum-Welch: tasks run the scaled forward-backward recursion over whole training
sequences and return expected counts; these are summed across tasks. All learning is
done by such rounds, and over all training sequences: a hash deals them to ``SHARES``
shares, a round goes over one share, and the next parameters come from the counts
found last in every share, so that an epoch of ``SHARES`` rounds meets every sequence
once and improves the model as often (incremental EM, whose fixed points are those of
rounds over everything). States that start alike stay alike for many rounds, so the
starts are models whose states differ: in ``GROUPED`` of them every training document
is put into the group of a state by its most telling class, and each state shows the
class shares of its group and tends to stay; one has random emissions and moves. They
are improved side by side for ``START_EPOCHS`` epochs; the likeliest goes on until an
epoch gains less than ``TOLERANCE`` of the log likelihood. A
document's score is the exact likelihood of its whole word sequence, by the scaled
forward recursion.

Word counts are exact. Tasks cut their documents into chunks of about
``CHUNK_BYTES`` and write, per chunk, its distinct words with their counts and its
documents as numbers of these words; the counts of a word are summed over the
chunks and joined back to them, and the documents of a chunk are scored where its
words' totals arrive, a chunk or two a partition.

Sequences of more than ``PIECE`` tokens go through the same recursions in pieces,
exactly, and the pieces side by side with other sequences: products of the pieces'
transfer matrices give the forward and backward values at the borders. So the steps
that a task goes through one by one do not follow its longest document. The shares
are written apart, and a round reads its own with two tasks a core at most.

Tokens are runs of bytes other than ASCII white space, A-Z lower-cased, then one
end per document. Defined results: null text is the empty text (the end alone);
with no training document every count is 0; a null key is held out as empty text;
repeated rows give repeated results; an empty table gives no rows; other columns
are ignored. Every text is read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, on_workers, record_batch, settle, slices

STATES, CLASSES = 8, 2_048
#: Training ends with the epoch that raises the log likelihood by less than this share.
TOLERANCE = 1e-4
#: Shares of the sequences, starts from groups of documents, and epochs that each start gets.
SHARES, GROUPED, START_EPOCHS = 8, 2, 2
#: Class of the end, and its word (no token is empty).
END_CLASS, END = CLASSES, b""
CHUNK_BYTES = 24 << 20
#: Tokens of one piece of a long sequence, steps between scalings, and cells summed by class at a time.
PIECE, RESCALE, BLOCK = 1 << 11, 8, 1 << 13
#: Tokens of sequences that a task works at a time, and gathers before it does.
WORK_TOKENS, HOLD_TOKENS = 200_000, 1_500_000
#: Rows of one batch of words.
OUT_ROWS = 1 << 16
#: Sums in a row that a task returns, and tasks of a round for each core.
ACROSS, TASKS_A_CORE = 8, 2


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def class_of(word: bytes) -> int:
    return END_CLASS if word == END else xxhash.xxh32_intdigest(word) % CLASSES


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray       # states
    move: np.ndarray        # states x states
    emit: np.ndarray        # classes + 1 x states



@dataclass(frozen=True)
class Corpus:
    """Training tokens, distinct ones, and both by class."""
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


class Lattice:
    """Sequences side by side, longest first. Its cells are the positions of all
    sequences, step by step; ``at`` has the first cell of each step, ``ends`` the last
    cell of each sequence. Emissions are worked as shares of a class's greatest one, so
    a step can't shrink the values far, and they are scaled every ``RESCALE`` steps."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[self.order]
        lengths = lengths[self.order]
        width = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        at = np.concatenate([[0], np.cumsum(width)])
        self.at, self.ends = at.tolist(), at[lengths - 1] + np.arange(len(lengths))
        #: Which sequence each cell belongs to, and what it shows.
        self.who = np.arange(at[-1], dtype=np.int32)
        self.who -= np.repeat(at[:-1].astype(np.int32), width)
        places = starts.astype(np.int32)[self.who]
        places += np.repeat(np.arange(len(width), dtype=np.int32), width)
        self.seen = np.concatenate(sequences)[places].astype(np.intp)

    def _steps(self) -> list[tuple[int, int]]:
        return list(zip(self.at, self.at[1:]))

    def _forward(self, model: Hmm, first: np.ndarray, alphas: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Fills ``alphas``, if given, with the scaled forward values of the cells.
        From the longest sequence on: log likelihoods, but for the classes' greatest
        emissions, and the values at the ends; and what the scaled steps were divided by."""
        shares = shares_of_peak(model)[0]
        logs, ones, move, scales = np.zeros(len(self.order)), np.ones(len(model.start)), model.move, []
        alpha = before = first[self.order]
        shown, ends, seen = np.empty_like(before), np.empty_like(before), self.seen
        for t, (a, b) in enumerate(self._steps()):
            n = b - a
            if t:
                if n < len(alpha):
                    ends[n:len(alpha)] = alpha[n:]
                np.dot(alpha[:n], move, out=before[:n])
            emit = np.take(shares, seen[a:b], axis=0, out=shown[:n], mode="clip")
            alpha = np.multiply(before[:n], emit, out=emit if alphas is None else alphas[a:b])
            if t % RESCALE == RESCALE - 1:
                scale = np.dot(alpha, ones)
                logs[:n] += np.log(scale)
                scales.append(scale[:, None])
                alpha /= scales[-1]
        ends[:len(alpha)] = alpha
        return logs + np.log(ends.sum(axis=1)), ends, scales

    def forward(self, model: Hmm, first: np.ndarray) -> np.ndarray:
        """Log likelihood (natural) by sequence, in the given order; ``first`` has
        the starting distribution of each."""
        peaks, out = np.log(shares_of_peak(model)[1]), np.empty(len(self.order))
        out[self.order] = self._forward(model, first, None)[0] + np.bincount(self.who, peaks[self.seen], len(out))
        return out

    def expected(self, model: Hmm, first: np.ndarray, last: np.ndarray | None = None, room: np.ndarray | None = None
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray]:
        """Expected first states by sequence, moves, and emissions; log likelihood;
        the scaled forward values at the ends of the sequences. ``last``: by sequence
        the backward values at its end, at any scale (a piece that others follow).
        ``room``: rows for the cells, to be used again."""
        k, seen, (shares, peak) = len(model.start), self.seen, shares_of_peak(model)
        alphas = np.empty((len(seen), k)) if room is None else room[:len(seen)]
        logs, ends, scales = self._forward(model, first, alphas)
        after = np.ones_like(ends) if last is None else last[self.order]
        after = after / (ends * after).sum(axis=1)[:, None]
        back, moves, product = np.ascontiguousarray(model.move.T), np.zeros((k, k)), np.empty((k, k))
        betas, shown, emitted = np.empty_like(after), np.empty_like(after), np.zeros((k, CLASSES + 1))
        sent, ready = shown[:0], len(seen)                  # what a step sends back; cells before ``ready`` aren't summed
        for t, (a, b) in zip(range(len(self.at) - 2, -1, -1), reversed(self._steps())):
            alpha, beta, m, n = alphas[a:b], betas[:b - a], len(sent), b - a
            if m:
                moves += np.dot(alpha[:m].T, sent, out=product)
                np.dot(sent, back, out=beta[:m])
            if m < n:
                beta[m:] = after[m:n]
            emit = np.take(shares, seen[a:b], axis=0, out=shown[:n], mode="clip")
            sent = np.multiply(emit, beta, out=emit)
            if t % RESCALE == RESCALE - 1:
                sent /= scales[t // RESCALE]
            np.multiply(alpha, beta, out=alpha)             # the chances of the states
            if ready - a >= BLOCK or not t:                 # while they are in the cache
                for total, column in zip(emitted, np.ascontiguousarray(alphas[a:ready].T)):
                    total += np.bincount(seen[a:ready], column, CLASSES + 1)
                ready = a
        begun, end = np.empty_like(after), np.empty_like(after)
        begun[self.order], end[self.order] = alphas[:n], ends
        log = logs.sum() + np.bincount(seen, minlength=CLASSES + 1) @ np.log(peak)
        return begun, moves * model.move, emitted.T, float(log), end

    def transfers(self, model: Hmm) -> np.ndarray:
        """By sequence, at any scale: the chances of its tokens and of the state after
        it, for each state that it may begin in."""
        k, shares = len(model.start), shares_of_peak(model)[0]
        # By first state, sequence, state: a step is one product for all first states.
        now = np.repeat(np.eye(k)[:, None, :], len(self.order), axis=1)
        out, spare = np.empty((len(self.order), k, k)), np.empty_like(now)
        for t, (a, b) in enumerate(self._steps()):
            if b - a < now.shape[1]:
                out[self.order[b - a:now.shape[1]]] = now[:, b - a:].transpose(1, 0, 2)
                now = np.ascontiguousarray(now[:, :b - a])
                spare = np.empty_like(now)
            now *= shares.take(self.seen[a:b], axis=0)
            np.dot(now.reshape(-1, k), model.move, out=spare.reshape(-1, k))
            now, spare = spare, now
            if t % RESCALE == RESCALE - 1:
                now /= now.sum(axis=(0, 2))[:, None]
        out[self.order[:now.shape[1]]] = now.transpose(1, 0, 2)
        return out


def shares_of_peak(model: Hmm) -> tuple[np.ndarray, np.ndarray]:
    peak = model.emit.max(axis=1)
    return model.emit / peak[:, None], peak


class Pieces:
    """Sequences cut into pieces of at most ``size`` tokens, which are worked side by
    side: products of the pieces' transfers give the values at the borders."""

    def __init__(self, sequences: list[np.ndarray], size: int):
        counts = np.array([-(-len(s) // size) for s in sequences])
        self.parts = [s[at:at + size] for s in sequences for at in range(0, len(s), size)]
        self.of = np.repeat(np.arange(len(sequences)), counts)
        begins = np.cumsum(counts) - counts
        #: Pieces of cut sequences, and which pieces begin a sequence or have one after them.
        self.runs = [(int(a), int(a + n)) for a, n in zip(begins, counts) if n > 1]
        self.begins, self.goes_on = np.zeros(len(self.parts), bool), np.zeros(len(self.parts), bool)
        self.begins[begins] = True
        self.goes_on[:-1] = ~self.begins[1:]

    def lattices(self) -> Iterator[tuple[np.ndarray, Lattice]]:
        for group in worked(self.parts):
            yield np.array(group), Lattice([self.parts[i] for i in group])

    def transfers(self, models: list[Hmm]) -> list[dict[int, np.ndarray]]:
        """For each model, those of the pieces of cut sequences."""
        cut = [i for a, b in self.runs for i in range(a, b)]
        out: list[dict[int, np.ndarray]] = [{} for _ in models]
        for group in worked([self.parts[i] for i in cut]):
            lattice = Lattice([self.parts[cut[g]] for g in group])
            for found, model in zip(out, models):
                found.update(zip([cut[g] for g in group], lattice.transfers(model)))
        return out

    def firsts(self, model: Hmm, transfers: dict[int, np.ndarray]) -> np.ndarray:
        """By piece, the chances of the state at its first token, given what is before it."""
        out = np.tile(model.start, (len(self.parts), 1))
        for a, b in self.runs:
            for i in range(a + 1, b):
                x = out[i - 1] @ transfers[i - 1]
                out[i] = x / x.sum()
        return out

    def nexts(self, model: Hmm, transfers: dict[int, np.ndarray]) -> np.ndarray:
        """By piece, at any scale, the chances of what is after it, by the state at the
        first token there (1 where nothing is)."""
        out = np.ones((len(self.parts), len(model.start)))
        for a, b in self.runs:
            for i in range(b - 1, a, -1):
                x = transfers[i] @ out[i]
                out[i - 1] = x / x.sum()
        return out


def log_likelihoods(model: Hmm, sequences: list[np.ndarray], size: int | None = None) -> np.ndarray:
    """Log likelihood (natural) of each sequence."""
    pieces, out = Pieces(sequences, size or PIECE), np.zeros(len(sequences))
    firsts = pieces.firsts(model, pieces.transfers([model])[0])
    for group, lattice in pieces.lattices():
        out += np.bincount(pieces.of[group], lattice.forward(model, firsts[group]), len(out))
    return out


def long_log(model: Hmm, sequence: np.ndarray, size: int | None = None) -> float:
    """Log likelihood of a sequence, piece by piece."""
    return float(log_likelihoods(model, [sequence], size)[0])


def long_expected(model: Hmm, sequence: np.ndarray, size: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """``Lattice.expected`` of one sequence, piece by piece."""
    begun, *others = _counts(summed([sequence], model, size), len(model.start))
    return begun[None, :], *others


def worked(sequences: list[np.ndarray]):
    """Positions of the sequences in groups of like lengths and bounded tokens."""
    group, size = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: len(sequences[i])):
        if group and size + len(sequences[i]) > WORK_TOKENS:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(sequences[i])
    if group:
        yield group


def first_model(corpus: Corpus, states: int = STATES, seed: int = 11) -> Hmm:
    """Random moves; emissions near the class shares, told apart by noise."""
    rng = np.random.default_rng(seed)
    share = class_share(corpus)
    emit = share[:, None] * rng.uniform(0.5, 1.5, (CLASSES + 1, states))
    move = rng.dirichlet(np.full(states, 5.0), states)
    return Hmm(np.full(states, 1.0 / states), move, emit / emit.sum(axis=0))


def sharp_model(corpus: Corpus, seed: int, states: int = STATES) -> Hmm:
    """Random moves; emissions of widely different states."""
    rng = np.random.default_rng(seed)
    emit = class_share(corpus)[:, None] * (rng.gamma(0.5, 1.0, (CLASSES + 1, states)) + 1e-9)
    move = rng.dirichlet(np.full(states, 5.0), states)
    return Hmm(np.full(states, 1.0 / states), move, emit / emit.sum(axis=0))


def grouped_model(corpus: Corpus, groups: np.ndarray, seed: int) -> Hmm:
    """States that tend to stay; each emits half the class shares of a group of
    documents (a row of class counts), half those of the corpus, with a little
    noise, as groups may be alike or empty."""
    rng = np.random.default_rng(seed)
    counts = groups.T + class_share(corpus)[:, None]
    shown = counts / counts.sum(axis=0)
    emit = (class_share(corpus)[:, None] + shown) * rng.uniform(0.9, 1.1, shown.shape)
    k = len(groups)
    return Hmm(np.full(k, 1.0 / k), 0.9 * np.eye(k) + 0.1 / k, emit / emit.sum(axis=0))


def class_share(corpus: Corpus) -> np.ndarray:
    return (corpus.class_tokens + 1.0) / (corpus.tokens + CLASSES + 1.0)


def next_model(begun: np.ndarray, moves: np.ndarray, emitted: np.ndarray, corpus: Corpus) -> Hmm:
    """Expected counts, with one token's worth of the class shares for each state."""
    start, move = begun + 0.1, moves + 0.1
    emit = emitted + class_share(corpus)[:, None]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def summed(sequences: list[np.ndarray], model: Hmm, size: int | None = None) -> np.ndarray:
    """Expected counts of the sequences, one cell after the other, and their log likelihood."""
    return summed_each(sequences, [model], size)[0]


def summed_each(sequences: list[np.ndarray], models: list[Hmm], size: int | None = None) -> np.ndarray:
    """``summed`` for each of the models (of equal size)."""
    pieces, room = Pieces(sequences, size or PIECE), None
    borders = [(pieces.firsts(model, found), pieces.nexts(model, found))
               for model, found in zip(models, pieces.transfers(models))]
    out = np.zeros((len(models), _cells(models[0]) + 1))
    for group, lattice in pieces.lattices():
        if room is None or len(room) < len(lattice.seen):   # fresh memory for every group costs as much as the work
            room = np.empty((max(WORK_TOKENS, len(lattice.seen)), len(models[0].start)))
        begins, goes_on = pieces.begins[group], pieces.goes_on[group]
        for total, model, (firsts, nexts) in zip(out, models, borders):
            ahead = nexts[group]
            begun, moves, emitted, log, ends = lattice.expected(model, firsts[group], ahead @ model.move.T, room)
            # The moves over the borders.
            ends, ahead = ends[goes_on], ahead[goes_on]
            ends = ends / ((ends @ model.move) * ahead).sum(axis=1)[:, None]
            moves = moves + (ends.T @ ahead) * model.move
            total += np.concatenate([begun[begins].sum(axis=0), moves.ravel(), emitted.ravel(), [log]])
    return out


def _cells(model: Hmm) -> int:
    return len(model.start) * (len(model.start) + CLASSES + 2)


def _counts(cells: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    a, b = states, states + states * states
    return cells[:a], cells[a:b].reshape(states, states), cells[b:-1].reshape(CLASSES + 1, states), float(cells[-1])


def expectations(sequences: DataFrame, models: list[Hmm]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """For each model (of equal size) the expected counts over all rows of
    ``classes``."""
    cells = _cells(models[0]) + 1
    shared = sequences.sparkSession.sparkContext.broadcast(models)

    def add(held: list[np.ndarray], total: np.ndarray) -> None:
        total += summed_each(held, shared.value).ravel()

    out = _summed_by_cell(sequences, cells * len(models), add)
    shared.destroy()
    return [_counts(out[k * cells:(k + 1) * cells], len(models[0].start)) for k in range(len(models))]


def _summed_by_cell(sequences: DataFrame, cells: int, add: Callable[[list[np.ndarray], np.ndarray], None]) -> np.ndarray:
    """``add`` adds what some sequences bring to a task's cells. Every task returns
    the cells, ``ACROSS`` in a row; the sums (a fixed number) reach the driver. There
    are two tasks a core at most, so what they return doesn't grow with the table."""
    names = [f"v{k}" for k in range(ACROSS)]
    ddl = ", ".join(["row int", *(f"{name} double" for name in names)])
    schema, rows_out = arrow_schema(ddl), -(-cells // ACROSS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size, rows = np.zeros(rows_out * ACROSS), [], 0, 0
        for batch in batches:
            for row in batch.column(0).to_pylist():
                held.append(np.frombuffer(row, "<u2"))
                size, rows = size + len(held[-1]), rows + 1
                if size >= HOLD_TOKENS:
                    add(held, total[:cells])
                    held, size = [], 0
        if held:
            add(held, total[:cells])
        if rows:
            table = total.reshape(-1, ACROSS)
            yield record_batch({"row": np.arange(rows_out, dtype=np.int32), **{n: table[:, k] for k, n in enumerate(names)}}, schema)

    tasks = TASKS_A_CORE * sequences.sparkSession.sparkContext.defaultParallelism
    sums = (sequences.coalesce(tasks).mapInArrow(run, ddl).groupBy("row")
            .agg(*[F.sum(name).alias(name) for name in names]).toArrow())
    out = np.zeros((rows_out, ACROSS))
    out[sums.column("row").to_numpy()] = np.stack([sums.column(name).to_numpy() for name in names], axis=1)
    return out.ravel()[:cells]


def improved(sequences: DataFrame, models: list[Hmm], corpus: Corpus, rounds: int) -> list[Hmm]:
    """So many rounds over all sequences."""
    for _ in range(rounds):
        models = [next_model(*counts[:3], corpus) for counts in expectations(sequences, models)]
    return models


def shared_out(sequences: DataFrame) -> DataFrame:
    """(classes, share), written share by share, so that a round reads its own alone."""
    share = F.pmod(F.xxhash64("classes"), F.lit(SHARES)).cast("int")
    return settle(sequences.select("classes", share.alias("share")), "sequences", "share")


def epoch(sequences: DataFrame, models: list[Hmm], corpus: Corpus, found: list) -> tuple[list[Hmm], list[float]]:
    """A round over each share of the sequences (of ``shared_out``). ``found`` has the counts found last,
    by share and model; a share's are replaced by its round. In the first epoch, when
    it is empty, the older half of the counts, which poorer models gave, does not
    count until all shares have been met. Returns the models, and the log likelihoods
    of all sequences, each by the model that its share met."""
    first = not found
    for k in range(SHARES):
        found[k:k + 1] = [expectations(sequences.where(F.col("share") == k).select("classes"), models)]
        used = found[len(found) // 2:] if first and k < SHARES - 1 else found
        models = [next_model(*[sum(part) for part in zip(*[counts[m][:3] for counts in used])], corpus)
                  for m in range(len(models))]
    return models, [sum(counts[m][3] for counts in found) for m in range(len(models))]


def train(sequences: DataFrame, corpus: Corpus, rounds: int | None = None) -> Hmm:
    """From the column ``classes``, all of it. A given number of ``rounds`` instead
    starts from ``first_model`` and shows what each brings."""
    if not corpus.tokens or rounds == 0:
        return first_model(corpus)
    if rounds is not None:
        return improved(sequences, [first_model(corpus)], corpus, rounds)[0]
    sequences = shared_out(sequences)
    models, found = starts(sequences.select("classes"), corpus), []
    for _ in range(START_EPOCHS):
        models, logs = epoch(sequences, models, corpus, found)
    best = int(np.argmax(logs))
    models, found, fit = [models[best]], [[counts[best]] for counts in found], logs[best]
    while True:
        models, [now] = epoch(sequences, models, corpus, found)
        if not now - fit > TOLERANCE * abs(fit):
            return models[0]
        fit = now


def starts(sequences: DataFrame, corpus: Corpus) -> list[Hmm]:
    """GROUPED models from the class counts of groups of all documents, and a random one."""
    return [*[grouped_model(corpus, groups, 11 + k) for k, groups in enumerate(grouped(sequences, corpus))],
            sharp_model(corpus, 11)]


def grouped(sequences: DataFrame, corpus: Corpus, states: int = STATES) -> np.ndarray:
    """Class counts by start, state and class. A document's most telling class is the
    one whose share in it is farthest above the corpus's, in standard deviations; a
    hash of that class, another for each start, names the state."""
    usual = np.sqrt(class_share(corpus))[:END_CLASS]
    state = np.array([[xxhash.xxh32_intdigest(int(c).to_bytes(2, "little"), k) % states for c in range(CLASSES)]
                      for k in range(GROUPED)])
    shape = (GROUPED, states, CLASSES + 1)

    def add(held: list[np.ndarray], total: np.ndarray) -> None:
        cells = total.reshape(shape)
        for seen in held:
            counts = np.bincount(seen, minlength=CLASSES + 1)
            telling = int(np.argmax(counts[:END_CLASS] / (len(seen) * usual) - usual))
            for k in range(GROUPED):
                cells[k, state[k, telling]] += counts

    return _summed_by_cell(sequences, int(np.prod(shape)), add).reshape(shape)


def chunked(rows: DataFrame, chunk_bytes: int | None = None) -> DataFrame:
    """From (id, train, text), settled: for each chunk (``part``, ``chunk``) its
    distinct words (kind 0: number, word, class, training count) and its documents
    (kind 1: id, train, the numbers of their words and their classes)."""
    limit = chunk_bytes or CHUNK_BYTES
    key = field(rows, "id")
    ddl = (f"part int, chunk int, kind int, number int, word binary, class int, own bigint, id {key}, "
           "train boolean, ids binary, classes binary")
    schema = arrow_schema(ddl)
    on_workers(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        numbers, ids, trained, found, size = _Numbers(), [], [], [], 0

        def emit(kind: int, n: int, **columns) -> pa.RecordBatch:
            whole = {k: np.full(n, v, np.int32) for k, v in (("part", part), ("chunk", chunk), ("kind", kind))} | columns
            return pa.RecordBatch.from_arrays(
                [whole[f.name] if isinstance(whole.get(f.name), pa.Array) else
                 pa.array(whole[f.name], f.type) if f.name in whole else pa.nulls(n, f.type) for f in schema], schema=schema)

        def written() -> Iterator[pa.RecordBatch]:
            words = list(numbers)
            # As class_of, for many words at a time; the end is word 0.
            classes = (np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words)) % CLASSES).astype(np.int32)
            classes[0] = END_CLASS
            learned = [f for f, t in zip(found, trained) if t]
            own = np.bincount(np.concatenate(learned), minlength=len(words)) if learned else np.zeros(len(words), np.int64)
            for a in range(0, len(words), OUT_ROWS):
                b = min(a + OUT_ROWS, len(words))
                yield emit(0, b - a, number=np.arange(a, b, dtype=np.int32), word=words[a:b], own=own[a:b], **{"class": classes[a:b]})
            narrow = classes.astype("<u2")
            # A document's row is a few bytes a token: batches of about the size of a slice.
            for a, b in _runs([len(f) for f in found], WORK_TOKENS):
                yield emit(1, b - a, number=np.arange(a, b, dtype=np.int32), train=trained[a:b],
                           id=pa.array(ids[a:b], schema.field("id").type), ids=[f.tobytes() for f in found[a:b]],
                           classes=[narrow[f].tobytes() for f in found[a:b]])

        for batch in batches:
            for piece in slices(batch):
                for i, train, text in zip(*[c.to_pylist() for c in piece.columns]):
                    words = tokens(text)
                    row = np.zeros(len(words) + 1, "<u4")       # the end is word 0
                    row[:-1] = np.fromiter(map(numbers.__getitem__, words), "<u4", len(words))
                    ids.append(i), trained.append(train), found.append(row)
                    size += len(text)
                    if size >= limit:
                        yield from written()
                        chunk, size = chunk + 1, 0
                        numbers, ids, trained, found = _Numbers(), [], [], []
        if found:
            yield from written()

    return settle(rows.select("id", "train", "text").mapInArrow(run, ddl), "chunks")


class _Numbers(dict):
    """Numbers of words in the order of their coming; the end has 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def _runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of about ``most`` in all (one item at least)."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > most:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def word_totals(chunks: DataFrame) -> DataFrame:
    """(word, class, total) of every distinct word. Settled."""
    words = chunks.where("kind = 0")
    return settle(words.groupBy("word").agg(F.min("class").alias("class"), F.sum("own").alias("total")), "words")


def corpus_figures(totals: DataFrame) -> Corpus:
    found = (totals.groupBy("class").agg(
        F.sum("total").alias("n"), F.sum((F.col("total") > 0).cast("bigint")).alias("v")).collect())
    n, v = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    for c, of_n, of_v in found:
        n[c], v[c] = of_n, of_v
    return Corpus(int(n.sum()), int(v.sum()), n, v)


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int | None = None) -> DataFrame:
    """Learn from the rows where the column ``held_out`` is false, score all: id,
    held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col(id_col).alias("id"), (~held_out).alias("train"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = chunked(rows)
    totals = word_totals(chunks)
    corpus = corpus_figures(totals)
    model = train(chunks.where("kind = 1 AND train").select("classes"), corpus, rounds)
    return _scored(chunks, totals, corpus, model)


def _scored(chunks: DataFrame, totals: DataFrame, corpus: Corpus, model: Hmm) -> DataFrame:
    """Chunks are dealt to partitions one by one, whatever input partition they come
    from: a chunk's words with their totals, then its documents."""
    key = field(chunks, "id")
    shared = chunks.sparkSession.sparkContext.broadcast((corpus, model))
    ddl = (f"id {key}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double")
    schema = arrow_schema(ddl)
    # Word 0 is the end, so a chunk has it once. Numbers part by part, then chunk by chunk, meet nowhere.
    n, part, chunk = chunks.where("kind = 0 AND number = 0").agg(F.count("*"), F.max("part"), F.max("chunk")).first()
    parts = max(1, min(((part or 0) + 1) * ((chunk or 0) + 1), 2 * n))
    # One number sorts a chunk's rows, words first. A chunk's is far below 2 ** 30; where it isn't, the product raises.
    chunk_no = F.col("chunk").cast("bigint") * ((part or 0) + 1) + F.col("part")
    key_of = (chunk_no * (1 << 33) + F.col("kind").cast("bigint") * (1 << 32) + F.col("number")).alias("key")
    known = chunks.where("kind = 0").select(key_of, "word").join(totals, "word").select("key", "class", "total")
    rows = known.unionByName(chunks.where("kind = 1").select(key_of, "id", "train", "ids"), allowMissingColumns=True)
    place = F.pmod(F.shiftright("key", 33), F.lit(parts)).cast("int")
    dealt = rows.repartitionById(parts, place).sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, model = shared.value
        at, held, size = None, [], 0
        counts, classes = [], []
        base = inside = count = of_class = None

        def add(document: dict) -> None:
            seen = np.frombuffer(document["ids"], "<u4")
            held.append((document["id"], not document["train"], len(seen), int((count[seen] > 0).sum()),
                         float(base[seen].sum()), float(inside[seen].sum()), of_class[seen].astype("<u2")))

        def scored() -> pa.RecordBatch:
            log = log_likelihoods(model, [h[6] for h in held])
            out = {"id": [h[0] for h in held], "held_out": [h[1] for h in held], "n_tokens": [h[2] for h in held],
                   "n_known": [h[3] for h in held], "train_tokens": [corpus.tokens] * len(held),
                   "base_score": [h[4] for h in held],
                   "score": ((log + np.array([h[5] for h in held])) / np.log(10)).tolist()}
            held.clear()
            return record_batch(out, schema)

        for batch in batches:
            for piece in slices(batch):
                kinds = piece.column("key").to_numpy() >> 32 & 1
                edges = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)] if len(kinds) else [0]
                for a, b in zip(edges, edges[1:]):
                    run_ = piece.slice(a, b - a)
                    if kinds[a] == 0:
                        if at is not None:                       # the first words of another chunk
                            counts, classes, at = [], [], None
                        counts.append(run_.column("total").to_numpy())
                        classes.append(run_.column("class").to_numpy())
                        continue
                    if at is None:
                        at, count, of_class = True, np.concatenate(counts), np.concatenate(classes)
                        base = np.log10((count + 1) / (corpus.tokens + corpus.distinct + 1))
                        inside = np.log((count + 1) / (corpus.class_tokens + corpus.class_distinct + 1)[of_class])
                        inside[of_class == END_CLASS] = 0.0      # the end is its class's only word
                    for document in run_.select(["id", "train", "ids"]).to_pylist():
                        add(document)
                        size += held[-1][2]
                    if size >= HOLD_TOKENS:
                        yield scored()
                        size = 0
        if held:
            yield scored()

    return dealt.mapInArrow(run, ddl)
