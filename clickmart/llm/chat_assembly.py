r"""Chat formatting by token-level assembly.

A turn is ``<|turn|>role<|body|>text<|end|>``. Role and text are encoded
separately as ordinary text and the three marks are spliced in as reserved
ids above the vocabulary, so no text can become a mark. In the text form
the same holds by escaping: ``\`` becomes ``\\`` and a control string in a
role or text gets a ``\`` after its first character, which ``unescape``
takes back exactly. The loss mask comes from the prefix sums of segment
lengths: it covers the text and end mark of the trained roles.

Turns are encoded row by row where they are read. ``with_offsets`` gives
each its place in the conversation's sequence by two-level prefix sums
(within and across runs of ``RUN`` turn numbers), so one with a third of
all rows is spread over tasks. ``read_back`` decodes where the rows are,
too; only the text that its digests need is shuffled, once. A digest of a
whole conversation is one running hash, so its text streams through one
task, which holds a batch of it.

Defined results: null text or role is empty; turns are ordered by turn,
role and text, nulls first, so ties and repeated rows have one order and
stay; null conversation ids are one conversation; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read_table
from .encoding import default_path, encoder

MARKS = ("<|turn|>", "<|body|>", "<|end|>")
# Strings that chat templates in use give a meaning.
CONTROL = MARKS + (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
    "<|system|>", "<|user|>", "<|assistant|>",
)
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: Turn numbers per run of the two-level prefix sums.
RUN = 1024


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_roles: tuple[str, ...] = ("assistant",),
    tokenizer_path: str | None = None,
) -> DataFrame:
    """Per turn: conv, turn, role, text (as given), formatted, ids, loss_mask, n_tokens.

    A conversation's training sequence is its turns' ``ids`` in order
    (``with_offsets`` adds their places in it).
    """
    path = tokenizer_path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        turn, body, end = (np.array([enc.size + i], "<u4").tobytes() for i in range(3))
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            formatted, parts, lengths, trained = [], [], [], []
            for role, text in zip(roles, texts):
                role_text, body_text = escape(role or ""), escape(text or "")
                a, b = enc.encode(role_text), enc.encode(body_text)
                formatted.append(f"{MARKS[0]}{role_text}{MARKS[1]}{body_text}{MARKS[2]}")
                parts += [turn, a, body, b, end]
                lengths.append((1, len(a) // 4, 1, len(b) // 4, 1))
                trained.append(role in trained_roles)
            seg = np.array(lengths, np.int64).reshape(-1, 5)
            ends = np.cumsum(seg.ravel()).reshape(-1, 5)
            ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
            # +1 where a trained text begins, -1 behind its end mark; the running sum is the mask
            step = np.zeros(len(ids) + 1, np.int8)
            on = np.flatnonzero(np.array(trained, bool))
            step[ends[on, 2]] += 1
            np.subtract.at(step, ends[on, 4], 1)
            mask = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
            offsets = pa.array(np.concatenate([[0], ends[:, 4]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv", "turn", "role", "text")]
                + [
                    pa.array(formatted, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(ids)),
                    pa.ListArray.from_arrays(offsets, pa.array(mask)),
                    pa.array(seg.sum(axis=1)),
                ],
                ["conv", "turn", "role", "text", "formatted", "ids", "loss_mask", "n_tokens"],
            )

    src = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )
    kinds = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in ("conv", "turn"))
    return src.mapInArrow(
        run, f"{kinds}, role string, text string, formatted string, ids array<int>, loss_mask array<boolean>, n_tokens bigint"
    )


TURN_ORDER = ("turn", "role", "text")


def with_offsets(turns: DataFrame) -> DataFrame:
    """Adds token_start: the number of tokens before a turn in its conversation."""
    run = F.floor(F.col("turn") / RUN).alias("run")
    sums = turns.groupBy("conv", run).agg(F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy("conv").orderBy(F.col("run").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv").alias("b_conv"), F.col("run").alias("b_run"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    )
    order = [F.col(c).asc_nulls_first() for c in TURN_ORDER]
    within = Window.partitionBy("conv", "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        turns.withColumn("run", F.floor(F.col("turn") / RUN))
        .withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(sums, [F.col("conv").eqNullSafe(F.col("b_conv")), F.col("run").eqNullSafe(F.col("b_run"))])
        .withColumn("token_start", F.col("base") + F.col("inner"))
        .drop("run", "inner", "b_conv", "b_run", "base")
    )


def decode_turns(turns: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Per turn, from its ids and mask alone: conv, turn, role and text unescaped, trained, formatted_chars.

    ``no_role`` and ``no_text`` are carried from the given columns, to order
    ties. The text under the mask is the whole text of a trained turn;
    anything else is an error, as is a sequence that is not one turn.
    """
    path = tokenizer_path or default_path()

    def segments(ids: np.ndarray, mask: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, bool]:
        marks = np.flatnonzero(ids >= first)
        if [int(ids[m]) - first for m in marks] != [0, 1, 2] or marks[0] != 0 or marks[2] != len(ids) - 1:
            raise ValueError("not a turn")
        trained = bool(mask.any())
        if trained and not (mask[marks[1] + 1 :].all() and not mask[: marks[1] + 1].any()):
            raise ValueError("the mask is not a turn's text")
        return ids[1 : marks[1]], ids[marks[1] + 1 : marks[2]], trained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids, mask = batch.column("ids"), batch.column("loss_mask")
            at, m_at = ids.offsets.to_numpy(), mask.offsets.to_numpy()
            flat, on = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
            parts = [segments(flat[at[i] : at[i + 1]], on[m_at[i] : m_at[i + 1]], enc.size) for i in range(len(batch))]
            texts = enc.decode_all([x.tolist() for role, text, _ in parts for x in (role, text)])
            roles, bodies = texts[::2], texts[1::2]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv", "turn", "no_role", "no_text")]
                + [
                    pa.array([unescape(r) for r in roles], pa.string()),
                    pa.array([unescape(t) for t in bodies], pa.string()),
                    pa.array([trained for _, _, trained in parts], pa.bool_()),
                    pa.array([sum(map(len, MARKS)) + len(r) + len(t) for r, t in zip(roles, bodies)], pa.int64()),
                ],
                ["conv", "turn", "no_role", "no_text", "role", "text", "trained", "formatted_chars"],
            )

    kinds = ", ".join(f"{c} {turns.schema[c].dataType.simpleString()}" for c in ("conv", "turn"))
    return turns.select(
        "conv", "turn", F.col("role").isNull().alias("no_role"), F.col("text").isNull().alias("no_text"), "ids", "loss_mask"
    ).mapInArrow(
        run, f"{kinds}, no_role boolean, no_text boolean, role string, text string, trained boolean, formatted_chars bigint"
    )


class _Digests:
    """Running digests of one conversation, fed with its turns in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, role: str, text: str, trained: bool, formatted_chars: int) -> None:
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.formatted_chars += formatted_chars
        if trained:
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self, conv) -> tuple:
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(turns: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Digests per conversation, worked out from ids and masks alone (see ``decode_turns``).

    Decoded turns are dealt out by conversation and sorted; each task
    streams them, holding one batch and one conversation's running digests.
    """
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, kind = None, None, None

        def out(done):
            kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], cols)

        for batch in batches:
            kind = batch.column("conv").type
            done = []
            fields = (batch.column(c).to_pylist() for c in ("conv", "role", "text", "trained", "formatted_chars"))
            for conv, *turn in zip(*fields):
                if state is None or conv != key:
                    if state is not None:
                        done.append(state.row(key))
                    key, state = conv, _Digests()
                state.add(*turn)
            yield out(done)
        if state is not None:
            yield out([state.row(key)])

    kind = turns.schema["conv"].dataType.simpleString()
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn")]
    order += [F.col("no_role").desc(), F.col("role"), F.col("no_text").desc(), F.col("text")]  # nulls before empty ones
    return (
        decode_turns(turns, tokenizer_path)
        .repartition("conv")
        .sortWithinPartitions(*order)
        .select("conv", "role", "text", "trained", "formatted_chars")
        .mapInArrow(
            run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
        )
    )


PROBE = "</s>[INST] ok [/INST]"


def op8_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(rows.unionByName(probe)))


def _escaped_sql(col: str) -> str:
    out = rf"replace({col}, '\', '\\')"
    for c in CONTROL:
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


OP8_SQL = rf"""
with r as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, 'assistant', '{PROBE}'),
t as (select conv_id, turn, role, text, coalesce(role, '') ro, coalesce(text, '') te from r)
select conv_id, count(*) n_turns,
       sha256(string_agg(ro || chr(10) || te || chr(10), '' order by turn nulls first, role nulls first, text nulls first)) turns_sha256,
       cast(coalesce(sum(length(te)) filter (role = 'assistant'), 0) as bigint) loss_chars,
       sha256(coalesce(string_agg(te, '' order by turn nulls first, role nulls first, text nulls first) filter (role = 'assistant'), '')) loss_sha256,
       cast(sum({sum(map(len, MARKS))} + length({_escaped_sql("ro")}) + length({_escaped_sql("te")})) as bigint) formatted_chars
from t group by conv_id
"""
