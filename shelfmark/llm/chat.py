"""Chat formatting with a grammar that is read back.

Grammar of a formatted conversation, DataFrame functions only:

    conversation := turn*
    turn         := "[INST " role "]" body "[/INST]"      body holds the text as it is
                  | "[INST* " role "]" body "[/INST]"     body holds the escaped text
    role         := the role with % [ ] written as %25 %5B %5D

Escaping puts a backslash before a backslash and after the bracket of `[INST`
and `[/INST`. A conversation is first written without escapes and parsed; if
the turns found are not those of the source, the texts with control strings are
escaped and it is parsed again, and if that should fail all texts are escaped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import materialize

_TURN = r"(?s)\[INST(\*?) ([^\]]*)\](.*?)\[/INST\]"
#: Characters of a turn that are neither role nor body, without the star.
FRAME = len("[INST ") + len("]") + len("[/INST]")
CONTROL = r"\[/?INST"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("[INST"), F.lit("[\\INST")), F.lit("[/INST"), F.lit("[\\/INST"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role_out(role: Column) -> Column:
    for char, code in (("%", "%25"), ("[", "%5B"), ("]", "%5D")):
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def _role_in(role: Column) -> Column:
    for char, code in (("[", "%5B"), ("]", "%5D"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def _bodies(turns: Column, level: int) -> Column:
    """Turns as (role, star, body) at an escape level: 0 none, 1 texts with control strings, 2 all."""

    def turn(t: Column) -> Column:
        chosen = F.lit(False) if level == 0 else F.lit(True) if level == 2 else F.rlike(t["text"], F.lit(CONTROL))
        return F.struct(
            t["role"].alias("role"),
            F.when(chosen, "*").otherwise("").alias("star"),
            F.when(chosen, escape(t["text"])).otherwise(t["text"]).alias("body"),
        )

    return F.transform(turns, turn)


def render(bodies: Column) -> Column:
    return F.array_join(
        F.transform(
            bodies,
            lambda b: F.concat(F.lit("[INST"), b["star"], F.lit(" "), _role_out(b["role"]), F.lit("]"), b["body"], F.lit("[/INST]")),
        ),
        "",
    )


def parse(formatted: Column) -> Column:
    """Turns (role, text, raw_chars) of a formatted text, by the grammar; null if anything is left over."""
    stars, roles, bodies = (F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(i)) for i in (1, 2, 3))
    found = F.zip_with(
        F.arrays_zip(stars.alias("s"), roles.alias("r")),
        bodies,
        lambda head, body: F.struct(
            _role_in(head["r"]).alias("role"),
            F.when(head["s"] == "*", unescape(body)).otherwise(body).alias("text"),
            F.char_length(body).alias("raw_chars"),
            (F.char_length(head["s"]) + F.char_length(head["r"])).alias("head_chars"),
        ),
    )
    covered = F.aggregate(
        found, F.lit(0).cast("long"), lambda n, t: n + FRAME + t["raw_chars"] + t["head_chars"]
    )
    return F.when(
        covered == F.char_length(formatted),
        F.transform(found, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["raw_chars"].alias("raw_chars"))),
    )


def _same(parsed: Column, turns: Column) -> Column:
    plain = F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(plain == turns, F.lit(False))


def gather(rows: DataFrame) -> DataFrame:
    """One row per conversation: its turns (role, text) in order of turn, then role, then text.

    A null role or text counts as empty, a null turn comes first, repeated rows
    stay repeated, and rows without conv_id form one conversation. A
    conversation is one value in the output, so it must fit in a task.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.groupBy("conv_id").agg(
        F.transform(
            F.sort_array(F.collect_list(turn)),
            lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")),
        ).alias("turns")
    )


def format_chats(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, escape_level, loss_runs) of each conversation, read back before it is given out.

    `loss_runs` is the loss mask as run lengths over the code points of
    `formatted`: left out, counted, left out, counted, ...
    """
    out = gather(rows)
    for level in (0, 1, 2):
        out = out.withColumn(f"b{level}", _bodies(F.col("turns"), level)).withColumn(f"f{level}", render(F.col(f"b{level}")))
    good = [_same(parse(F.col(f"f{level}")), F.col("turns")) for level in (0, 1)]
    level = F.when(good[0], 0).when(good[1], 1).otherwise(2)
    out = out.withColumn("escape_level", level)

    def pick(name: str) -> Column:
        return reduce(lambda rest, i: F.when(F.col("escape_level") == i, F.col(f"{name}{i}")).otherwise(rest), (1, 0), F.col(f"{name}2"))

    def runs(b: Column) -> Column:
        before = F.char_length(b["star"]) + F.char_length(_role_out(b["role"])) + len("[INST ]")
        body, zero = F.char_length(b["body"]), F.lit(0)
        counted = b["role"] == loss_role
        return F.array(
            F.when(counted, before).otherwise(before + body),
            F.when(counted, body).otherwise(zero),
            F.lit(len("[/INST]")),
            zero,
        )

    return out.select(
        "conv_id",
        pick("f").alias("formatted"),
        "escape_level",
        F.flatten(F.transform(pick("b"), runs)).alias("loss_runs"),
    )


def under_mask(formatted: Column, runs: Column) -> Column:
    """The texts of `formatted` under the loss mask: unescaped where their turn has a star.

    Four run lengths are a turn: what stands before its text, the text, the end
    mark, and nothing. The star is read where the turn begins.
    """
    star_at = len("[INST")

    def step(acc: Column, n: Column) -> Column:
        star = F.when(acc["k"] == 0, F.substring(formatted, acc["at"] + star_at, F.lit(1)) == "*").otherwise(acc["star"])
        piece = F.substring(formatted, acc["at"], n)
        piece = F.when(star, unescape(piece)).otherwise(piece)
        counted = (acc["k"] == 1) & (n > 0)
        return F.struct(
            (acc["at"] + n).alias("at"), ((acc["k"] + 1) % 4).alias("k"), star.alias("star"),
            F.when(counted, F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(1).alias("at"), F.lit(0).alias("k"), F.lit(False).alias("star"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(runs, start, step)["out"]


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from nothing but its formatted text and loss mask.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, escape_level);
    the loss columns are of the texts under the mask, whatever the turns' roles.
    """
    turns = formatted.withColumn("turns", parse(F.col("formatted")))
    return (
        turns.withColumn("loss", F.array_join(under_mask(F.col("formatted"), F.col("loss_runs")), ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
            ).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss"), 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
            "escape_level",
        )
    )


def format_and_read(rows: DataFrame) -> DataFrame:
    """Format all conversations into a written table and give the digests read from it."""
    return read_back(materialize(format_chats(rows), "chats"))
