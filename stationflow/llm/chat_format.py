"""Conversations formatted for training in token-budgeted, turn-aligned windows."""

from __future__ import annotations

import base64
import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.llm.common import staged

BUDGET, HISTORY = 2048, 512
#: Budgets of turns that one task cuts into windows; longer conversations are dealt over tasks in such chapters.
CHAPTER = 64
#: Characters of a text that the sort compares; texts that are equal so far are told apart by hash.
KEY_CHARS = 256
#: Characters of turns that pass before finished windows are handed on.
BATCH_CHARS = 1 << 22
#: What a turn is to a chapter, in the order of reading: its system turn, history, or a turn of its own.
LEAD, TAIL, OWN = 0, 1, 2
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The first sign of a string that chat templates read as control, wherever it stands.
CONTROL = r"([<\[])(?=/?s>|/?INST\]|</?SYS>>|\|\w{1,40}\|>)"


def escape(text: Column) -> Column:
    """Backslashes are doubled, and one is put after the first sign of a control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _encoding(ranks_path: str, pattern: str):  # noqa: ANN202
    import tiktoken

    if (encoding := _encodings.get(ranks_path)) is None:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = _encodings[ranks_path] = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding


_encodings: dict = {}


def _in_order(df: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    """The turns, escaped and sorted; the last key lets a sort spread equal rows, which may stand in any order, over tasks."""
    conv, turn, role, text = names
    rows = df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).orderBy("conv_id", "turn", "role", F.substring("text", 1, KEY_CHARS), F.xxhash64("text"), "row")
    return rows.select("conv_id", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"), (F.col("role") == "system").alias("lead"))


def _counted(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Each sorted turn with its tokens and, within its task, the sum of its conversation's tokens before it."""
    extra = pa.schema([("part", pa.int32()), ("tokens", pa.int64()), ("upto", pa.int64()), ("opens", pa.bool_()), ("system", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, part = _encoding(ranks_path, pattern), TaskContext.get().partitionId()
        now, upto, system = object(), 0, 0
        for batch in batches:
            found = []
            for conv, head, body, _, lead in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = len(encoding.encode_ordinary(head + body + END))
                opens = conv != now
                if opens:
                    now, upto, system = conv, 0, tokens if lead else 0
                found.append((part, tokens, upto, opens, system))
                upto += tokens
            columns = list(zip(*found, strict=True)) or [[]] * len(extra)
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(c, f.type) for c, f in zip(columns, extra, strict=True)], names=batch.schema.names + extra.names)

    return rows.mapInArrow(run, "conv_id long, head string, body string, learn boolean, lead boolean, part int, tokens long, upto long, opens boolean, system long")


def _cut(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Windows of sorted chapters, built as the turns stream by; only the open window and its history are held."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("loss_spans", span), ("n_repeated", pa.int32()), ("n_turns", pa.int32()), ("n_tokens", pa.int64()), ("over_budget", pa.bool_())])

    def window(conv: int | None, again: list, own: list) -> tuple:
        spans, at = [], sum(len(t[0]) + len(t[1]) + len(END) for t in again)
        for head, body, learn, _, _ in own:
            if learn:
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            at += len(head) + len(body) + len(END)
        text = "".join(t[0] + t[1] + END for t in again + own)
        spent = sum(t[3] for t in again + own)
        return conv, own[0][4], text, spans, len(again), len(own), spent, spent > budget

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        system, past, kept, again, own, spent = None, deque(), 0, [], [], 0
        done, size = [], 0
        for batch in batches:
            for conv, chapter, kind, at, head, body, learn, tokens, is_system in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (conv, chapter):
                    if own:
                        done.append(window(key[0], again, own))
                    key, system, past, kept, again, own, spent = (conv, chapter), None, deque(), 0, [], [], 0
                turn = (head, body, learn, tokens, at)
                if kind == OWN:
                    if own and spent + tokens > budget:
                        done.append(window(conv, again, own))
                        own = []
                    if not own:
                        again = [system] if system else []
                        spent = sum(t[3] for t in again) + tokens
                        room, tail = min(history, budget - spent), []
                        for t in reversed(past):
                            room -= t[3]
                            if room < 0:
                                break
                            tail.append(t)
                        again += tail[::-1]
                        spent += sum(t[3] for t in tail)
                    else:
                        spent += tokens
                    own.append(turn)
                if kind == LEAD or is_system:
                    system = turn
                else:
                    past.append(turn)
                    kept += tokens
                    while kept > history:
                        kept -= past.popleft()[3]
                size += len(head) + len(body)
                if done and size > BATCH_CHARS:
                    yield _batch(done, schema)
                    done, size = [], 0
        if own:
            done.append(window(key[0], again, own))
        yield _batch(done, schema)

    return turns.mapInArrow(run, "conv_id long, window long, text string, loss_spans array<struct<start:int,end:int>>, n_repeated int, n_turns int, n_tokens long, over_budget boolean")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def format_chat(df: DataFrame, ranks_path: str, pattern: str, budget: int = BUDGET, history: int = HISTORY, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"), chapter: int = CHAPTER) -> DataFrame:
    """``conv_id, window, text, loss_spans, n_repeated, n_turns, n_tokens, over_budget``, one row for each window.

    Turns go in order of turn (null first), role and text (by its first KEY_CHARS
    characters, then by hash). Prefix sums of the turns' tokens, built along the tasks
    of one sort and then over the tasks, deal a conversation into chapters of
    ``chapter`` budgets; within a chapter each window takes as many whole turns as the budget
    leaves. ``window`` is the prefix sum at its first own turn. A leading
    system turn opens every window; after it the turns just before the window, up to
    ``history`` tokens and as far as its first own turn leaves room, are repeated. The loss spans (code points, end
    exclusive) cover the texts of a window's own assistant turns, so each is learned once.
    A single turn beyond the budget stays whole and is marked ``over_budget``; so is every
    window whose system turn leaves no room for its turn.

    Null roles and texts count as empty; rows without a conversation id form one
    conversation; repeated rows are repeated turns; a text of any length is one turn; other columns are left out; an empty
    table gives an empty result. Control strings in texts are escaped; ``unescape`` undoes it.
    """
    size = chapter * budget
    turns = staged(_counted(_in_order(df, names), ranks_path, pattern))
    by_part = Window.partitionBy("conv_id").orderBy("part")
    parts = turns.groupBy("conv_id", "part").agg(F.sum("tokens").alias("total"), F.first("system").alias("system"))
    parts = parts.select(
        F.col("conv_id").alias("c"),
        F.col("part").alias("p"),
        F.sum("total").over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.first("system").over(by_part.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.sum("total").over(Window.partitionBy("conv_id")).alias("all"),
    )
    # a task of the sort goes on with one conversation at most, so this has fewer rows than the sort has tasks
    carried = F.broadcast(parts.where("before is not null").select("c", "p", "before"))
    rows = turns.join(carried, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")), "left")
    rows = rows.withColumns({"at": F.coalesce("before", F.lit(0)) + F.col("upto"), "is_system": F.col("opens") & F.col("lead") & F.col("before").isNull()})
    rows = rows.select("conv_id", F.floor(F.col("at") / size).alias("nth"), "at", "head", "body", "learn", "tokens", "is_system")
    # the last turns of a chapter are history of the next one
    near = (F.col("at") >= (F.col("nth") + 1) * size - history) & ~F.col("is_system")
    dealt = rows.select("*", F.explode(F.when(near, F.array(F.lit(OWN), F.lit(TAIL))).otherwise(F.array(F.lit(OWN)))).alias("kind"))
    dealt = dealt.withColumn("chapter", F.col("nth") + (F.col("kind") == TAIL).cast("int")).drop("nth")
    long = parts.where(F.col("before").isNull() & (F.col("s") > 0) & (F.col("all") > size)).select("c", F.floor((F.col("all") - 1) / size).alias("last"))
    leads = rows.where("is_system").join(long, F.col("conv_id").eqNullSafe(F.col("c"))).select("*", F.lit(LEAD).alias("kind"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("last"))).alias("chapter")).drop("nth", "c", "last")
    dealt = dealt.unionByName(leads).select("conv_id", "chapter", "kind", "at", "head", "body", "learn", "tokens", "is_system")
    return _cut(dealt.repartition("conv_id", "chapter").sortWithinPartitions("conv_id", "chapter", "kind", "at"), budget, history)


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, window, roles, texts, learned, n_chars``: the own turns of each window, read from its text."""
    pattern = r"(?s)<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>"
    plain = lambda a: F.transform(F.slice(a, F.col("n_repeated") + 1, F.greatest(F.size(a), F.lit(1))), unescape)
    return windows.select(
        "conv_id",
        "window",
        plain(F.regexp_extract_all("text", F.lit(pattern), 1)).alias("roles"),
        plain(F.regexp_extract_all("text", F.lit(pattern), 2)).alias("texts"),
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))).alias("learned"),
        F.length("text").cast("long").alias("n_chars"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row for each conversation: digests of what ``read_back`` finds in its windows, in their order.

    A digest reads its conversation from front to back, so a conversation's windows
    stream through one task; only the running digests are held.
    """
    ordered = windows.select("conv_id", "window", "text", "loss_spans", "n_repeated").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    back = read_back(ordered).select("conv_id", F.size("roles").cast("long").alias("n"), F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "").alias("turns"), F.array_join("learned", "").alias("learned"), "n_chars")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        for batch in batches:
            done = []
            for conv, n, turns, learned, chars in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if now is None or now[0] != conv:
                    done += [now] if now is not None else []
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += n
                now[2].update(turns.encode("utf-8", "surrogatepass"))
                now[3] += len(learned)
                now[4].update(learned.encode("utf-8", "surrogatepass"))
                now[5] += chars
            yield _rows(done, schema)
        yield _rows([now] if now is not None else [], schema)

    return back.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _rows(done: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return _batch([(c, n, t.hexdigest(), k, s.hexdigest(), f) for c, n, t, k, s, f in done], schema)
