"""Chat formatting of typed content parts.

A message is a list of parts: text, image, audio or document.  A visitor walks over
them in order; text is escaped, every other part becomes a numbered placeholder,
with a record of its reference and of the tokens it expands to.  A turn reads

    ### role: content</turn>

and a backslash goes before each backslash, # and < of a text (and : of a role), so no text can hold a control
string and the text can be read back.  Turns are formatted row by row; a conversation is the
run of its turns, which no task ever holds whole.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratelake.llm.runtime import small_batches

#: Tokens of an image tile, of a second of audio and of a document page.
TILE_PIXELS, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 512, 170, 25, 500

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<placeholder:string,type:string,ref:string,tokens:bigint>"
TURN = ("conv_id long, turn long, role string, formatted string, loss_start int, loss_end int, "
        f"attachments array<{ATTACHMENT}>, expanded_tokens long")


class Flatten:
    """Visits the parts of one message and gathers its content."""

    def __init__(self):
        self.content, self.attachments = [], []

    def visit(self, part):
        handler = getattr(self, f"visit_{part.get('type') or 'text'}", None)
        if handler is None:
            raise ValueError(f"unknown content part {part.get('type')!r}")
        handler(part)

    def visit_text(self, part):
        self.content.append(re.sub(r"[\\#<]", r"\\\g<0>", part.get("text") or ""))

    def visit_image(self, part):
        tiles = -(-(part.get("width") or 1) // TILE_PIXELS) * -(-(part.get("height") or 1) // TILE_PIXELS)
        self.attach(part, tiles * TILE_TOKENS)

    def visit_audio(self, part):
        self.attach(part, int(-(-(part.get("seconds") or 0) // 1)) * SECOND_TOKENS)

    def visit_document(self, part):
        self.attach(part, (part.get("pages") or 1) * PAGE_TOKENS)

    def attach(self, part, tokens):
        name = f"<{part['type']}:{len(self.attachments) + 1}>"
        self.content.append(name)
        self.attachments.append({"placeholder": name, "type": part["type"], "ref": part.get("ref"), "tokens": tokens})


def text_part(text="text") -> Column:
    """A message that is one text, as parts."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            *[F.lit(None).cast(kind).alias(name) for name, kind in (
                                ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def turn_rows(visitor, trained_role):
    """Task body: each message as a formatted turn; the loss span covers the content of the trained role."""

    def body(batches):
        import re

        for batch in batches:
            out = []
            for role, parts in zip(batch.column("role").to_pylist(), batch.column("parts").to_pylist()):
                flat = visitor()
                for part in parts or ():
                    if part is not None:
                        flat.visit(part)
                head = "### " + re.sub(r"[\\#<:]", r"\\\g<0>", role or "") + ": "
                content = "".join(flat.content)
                span = (len(head), len(head) + len(content)) if role == trained_role else (0, 0)
                out.append((head + content + "</turn>\n", *span, flat.attachments,
                            sum(a["tokens"] for a in flat.attachments)))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct(
                [("placeholder", pa.string()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])), pa.int64())
            names = ("formatted", "loss_start", "loss_end", "attachments", "expanded_tokens")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "turn", "role")),
                 *(pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds))], names=["conv_id", "turn", "role", *names])

    return body


def format_turns(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One formatted row per message with ``conv_id, turn, role, parts``; see ``text_part`` for plain texts.

    Null roles, parts and texts count as empty; an unknown part type fails; repeated rows are formatted each; an
    empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
                           F.col("parts").cast(f"array<{PART}>").alias("parts"))
    return small_batches(rows).mapInArrow(turn_rows(by_value(Flatten), trained_role), TURN)


def read_back(digest):
    """Task body over turns in order: digests of each conversation, read from the formatted text alone."""

    def body(batches):
        import re

        turn = re.compile(r"### ((?:[^\\:#<]|\\.)*): ((?:[^\\#<]|\\.|<(?:image|audio|document):\d+>)*)</turn>\n", re.DOTALL)
        plain = re.compile(r"\\(.)", re.DOTALL)
        now, some = None, False
        for batch in batches:
            out = []
            for conv, text, start, end in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "formatted", "loss_start", "loss_end"))):
                if not some or conv != now.conv:
                    if some:
                        out.append(now.row())
                    now, some = digest(conv), True
                found = turn.fullmatch(text)
                if found is None:
                    raise ValueError(f"conversation {conv}: a turn does not follow the template")
                now.add(plain.sub(r"\1", found[1]), plain.sub(r"\1", found[2]), plain.sub(r"\1", text[start:end]), len(text))
            yield digest.batch(out)
        if some:
            yield digest.batch([now.row()])

    return body


class Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role, text, loss, size):
        self.turns += 1
        self.chars += size
        self.loss_chars += len(loss)
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())

    def row(self):
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)

    @staticmethod
    def batch(rows):
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of formatted turns: counts and digests read back from them.

    Turns stand by number, then by formatted text, null numbers first; rows without a ``conv_id`` are one conversation.
    A task reads turn after turn and keeps running digests only, so a conversation may be of any length.
    """
    # Whole conversations must meet, in order: one shuffle by conversation.
    ordered = turns.select("conv_id", "turn", "formatted", "loss_start", "loss_end") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(read_back(by_value(Digest)), "conv_id long, n_turns long, turns_sha256 string, "
                              "loss_chars long, loss_sha256 string, formatted_chars long")


def by_value(cls):
    """Let this module travel with the tasks, so that executors need no copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return cls


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, role))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(regexp_replace(text, '[\\#<]', '  ', 'g')) + length(role) + 14)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
