"""Chat formatting by incremental black-box rendering.

A template is any function from turns to a text. It is called with successive prefixes of a conversation, and each
output is compared with the one before: what is added is the turn's span, and where the earlier output is not a prefix of
the later one, the template rewrites history and the conversation is marked so, with the turn at which it happens.
Where a turn's text stands in the final output, which is where the loss mask lies, is found by rendering the conversation
with other texts for that turn and comparing the outputs. A text that isn't there, because a later turn rewrote it or the
template leaves it out, has no loss span; of a text that is there several times, the first place counts.

The built-in template marks turns and escapes control strings inside roles and texts reversibly: in each control string
a backslash is put behind the first character, one more where backslashes are there already, so that no control string is
left inside, and taking one away again restores the text.

Turns of a conversation are sorted within partitions and streamed. Every conversation is rendered by all its prefixes,
whatever its length, and the result is cut into blocks of ``BLOCK_TURNS`` turns afterwards; for this a task holds a whole
conversation, and the work grows with the square of its length. A template that has a true attribute ``local`` promises
that it renders each turn by itself and puts the outputs one behind the other, as the built-in one does. Its prefixes
within a block, with the last turn of the block before as context, say the same, so a task holds one block of turns only.

Defined cases: null texts and roles are empty. Turns are ordered by turn, null first, then role and text; repeated rows
are turns of their own. A null conv_id is a conversation like any other. Other columns are ignored. Positions count code
points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexapla.llm.common import written

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

BLOCK_TURNS = 256
#: Control strings of common chat templates; none of them is left inside a formatted text.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_ANY = "|".join(sorted({f"(?:{re.escape(c[0])}(?:B)*{re.escape(c[1:])})" for c in CONTROLS})).replace("B", r"\\")
_ESCAPE = re.compile(_ANY)
_ESCAPED = re.compile("|".join(sorted({f"(?:{re.escape(c[0])}(?:B)+{re.escape(c[1:])})" for c in CONTROLS})).replace("B", r"\\"))


def escape(text: str) -> str:
    """``text`` without control strings; ``unescape`` undoes it."""
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The text that was escaped."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def chatml(turns: list[Turn]) -> str:
    """Each turn between control strings, its role on the first line; line feeds in roles are escaped too."""
    return "".join(f"<|im_start|>{_role(r)}\n{escape(t)}<|im_end|>\n" for r, t in turns)


chatml.local = True


def _role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def parse_chatml(span: str) -> Turn:
    """Role and text of a turn's span."""
    if not (span.startswith("<|im_start|>") and span.endswith("<|im_end|>\n")):
        raise ValueError("not a turn")
    role, _, text = span[len("<|im_start|>") : -len("<|im_end|>\n")].partition("\n")
    return unescape(role).replace("%0A", "\n").replace("%25", "%"), unescape(text)


def render(template: Template, turns: list[Turn], first: int = 0) -> tuple[str, list[tuple[int, int]], int | None]:
    """The text of ``turns`` from number ``first`` on, the span of each of them in it, and the number of the turn at which
    history was rewritten (None: never). Turns before ``first`` are context."""
    done = template(turns[:first])
    base, spans, rewritten = len(done), [], None
    for k in range(first, len(turns)):
        text = template(turns[: k + 1])
        if not text.startswith(done):
            rewritten = k if rewritten is None else rewritten
            same = next((i for i, (a, b) in enumerate(zip(done, text, strict=False)) if a != b), min(len(done), len(text)))
            base, spans = min(base, same), [(min(a, same), min(b, same)) for a, b in spans]
            spans.append((same, len(text)))
        else:
            spans.append((len(done), len(text)))
        done = text
    return done[base:], [(a - base, b - base) for a, b in spans], rewritten


def text_span(template: Template, turns: list[Turn], k: int, whole: str) -> tuple[int, int] | None:
    """Where turn ``k``'s text stands in ``whole``, the output of ``turns``; None if it doesn't.

    The outputs for two other texts, of one letter each, differ where the text stands and nowhere else. As often as they
    differ, ``whole`` is longer than they are by the text but for a letter; what is before and behind must agree.
    """
    one, other = (template([*turns[:k], (turns[k][0], x), *turns[k + 1 :]]) for x in "ab")
    if len(one) != len(other):
        return None
    places = [i for i, (a, b) in enumerate(zip(one, other, strict=True)) if a != b] if one != other else []
    if not places or (len(whole) - len(one)) % len(places):
        return None
    size, start = (len(whole) - len(one)) // len(places) + 1, places[0]
    last = places[1] if len(places) > 1 else len(one)
    fits = size >= 0 and whole[:start] == one[:start] and whole[start + size : start + size + last - start - 1] == one[start + 1 : last]
    return (start, start + size) if fits else None


OUT = "conv_id long, block int, formatted string, spans array<struct<role:string,start:long,end:long,loss_start:long,loss_end:long>>, rewritten_at long"
_SPAN = pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_TYPES = [pa.int64(), pa.int32(), pa.string(), pa.list_(_SPAN), pa.int64()]


def formatted(turns: DataFrame, template: Template = chatml, loss_roles: tuple[str, ...] = ("assistant",), block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, block, formatted, spans, rewritten_at): each conversation's text in blocks of turns, every turn's span in
    its block's text, and for turns of ``loss_roles`` the span of their text, which is the loss mask (else, and where the
    final output doesn't have the text, null). Spans of texts that were moved may lie outside their block's text."""
    local = getattr(template, "local", False)
    rows = turns.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def blocks(conv, block: int, context: list[Turn], new: list[Turn]) -> Iterator[tuple]:
        given = context + new
        text, found, rewritten = render(template, given, len(context))
        final, spans = template(given), []
        base = len(final) - len(text)
        for k, (a, b) in enumerate(found, len(context)):
            role, loss = given[k][0], None
            if role in loss_roles and local:  # the turn's output is the same without the others
                loss = text_span(template, given[k : k + 1], 0, text[a:b])
                loss = loss and (a + loss[0], a + loss[1])
            elif role in loss_roles:
                loss = text_span(template, given, k, final)
                loss = loss and (loss[0] - base, loss[1] - base)
            spans.append((role, a, b, loss))
        rewritten = None if rewritten is None else rewritten - len(context) + block * block_turns
        for at in range(0, len(spans), block_turns):
            start = spans[at][1]
            end = spans[at + block_turns][1] if at + block_turns < len(spans) else len(text)
            part = [{"role": r, "start": a - start, "end": b - start, "loss_start": x and x[0] - start, "loss_end": x and x[1] - start} for r, a, b, x in spans[at : at + block_turns]]
            yield conv, block + at // block_turns, text[start:end], part, rewritten

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chars = [], 0
        now, block, context, held, begun = None, 0, [], [], False
        told, said = [], []  # a conversation of a local template in several blocks: its turns, and the blocks' texts

        def kept_promise() -> None:
            if said and template(told) != "".join(said):
                raise ValueError("the template renders turns differently in longer conversations; it must not be marked local")

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], ["conv_id", "block", "formatted", "spans", "rewritten_at"])

        for b in batches:
            for conv, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if begun and (conv != now or (local and len(held) == block_turns)):
                    made = list(blocks(now, block, context, held))
                    out += made
                    if local and (block or conv == now):
                        told += held
                        said += [x[2] for x in made]
                    if conv != now:
                        kept_promise()
                        told, said = [], []
                    chars += sum(len(x[2]) for x in made)
                    block, context = (block + 1, held[-1:]) if conv == now else (0, [])
                    held = []
                    if chars > 4_000_000:
                        yield batch()
                        out, chars = [], 0
                now, begun = conv, True
                held.append((role, text))
        if held:
            made = list(blocks(now, block, context, held))
            out += made
            if local and block:
                told += held
                said += [x[2] for x in made]
        kept_promise()
        if out:
            yield batch()

    return dealt.mapInArrow(stream, OUT)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(output: DataFrame, parse: Callable[[str], Turn] = parse_chatml) -> DataFrame:
    """What the formatted text says: each conversation's turns and loss, parsed from ``output``. Hashes are fed block by
    block."""
    names = [f.split()[0] for f in DIGEST.split(", ")]
    dealt = output.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "block", "formatted", "spans")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], None
        for b in batches:
            for conv, block, text, spans in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if block == 0:
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    out.append(now)
                for s in spans:
                    role, said = parse(text[s["start"] : s["end"]])
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                    if s["loss_start"] is not None:
                        loss = unescape(text[s["loss_start"] : s["loss_end"]])
                        now[3] += len(loss)
                        now[4].update(loss.encode())
                now[5] += len(text)
            done, out = (out[:-1], out[-1:]) if out else ([], [])
            if done:
                yield _digest_batch(done, names)
        if out:
            yield _digest_batch(out, names)

    return dealt.mapInArrow(read, DIGEST)


def _digest_batch(rows: list, names: list[str]) -> pa.RecordBatch:
    found = [[x.hexdigest() if hasattr(x, "hexdigest") else x for x in r] for r in rows]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)


def round_trip(turns: DataFrame) -> DataFrame:
    """Format the conversations, write them, and give the digests of what is read back."""
    return digests(written(formatted(turns), "chat-formatted"))
