"""Chat formatting from event logs, in DataFrame operations only.

An event log has one row per event: ``conv_id``, ``seq`` (the order within a
conversation), ``kind``, ``msg_id``, ``role``, ``text``:

* ``start``: opens message ``msg_id`` with ``role``; ``text`` is its first part;
* ``delta``: appends ``text`` to the message (streamed output);
* ``edit``: replaces what the message holds so far by ``text``;
* ``regenerate``: empties the message and withdraws every message whose place
  is after it; deltas that follow refill it.

The log is partitioned by conversation and sorted by sequence; running windows
and one fold over the contested events make the messages. The template marks turns

    [ROLE]role[INST]text[/INST]     any role but assistant
    <s>text</s>                     assistant: text under the loss mask

and escapes texts: a backslash is doubled, and a control string gets one after
its first character, so that no control string of a text survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CONTROLS = r"(\[|<)(ROLE\]|/?INST\]|/?s>)"
_TURN = r"(?s)\[ROLE\].*?\[INST\].*?\[/INST\]|<s>.*?</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROLS, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _fold(events: Column, msg_type: str) -> Column:
    """Folds a conversation's contested events (regenerations, and starts of
    messages that start more than once) in order: those that take effect, each
    with ``opening``, the place of the message that it belongs to.

    Withdrawn places are disjoint ranges, a new one absorbs those it spans;
    ``open`` holds the newest opening of each message of several starts.
    """
    def step(acc: Column, e: Column) -> Column:
        known = F.coalesce(
            F.when(e["only_start"] < e["at"], e["only_start"]),
            F.get(F.filter(acc["open"], lambda o: o["msg_id"].eqNullSafe(e["msg_id"])), F.lit(0))["opening"])
        live = F.when(~F.exists(acc["gone"], lambda r: (r["lo"] < known) & (known < r["hi"])), known)
        is_start = e["kind"] == "start"

        def act(place: Column) -> Column:
            done = F.struct(e["at"].alias("at"), e["kind"].alias("kind"), e["msg_id"].alias("msg_id"),
                            e["role"].alias("role"), e["text"].alias("text"), place.alias("opening"))
            return F.struct(
                F.when(~is_start & place.isNotNull(), F.concat(
                    F.filter(acc["gone"], lambda r: r["lo"] < place),
                    F.array(F.struct(place.alias("lo"), e["at"].alias("hi"))))).otherwise(acc["gone"]).alias("gone"),
                F.when(is_start & (place == e["at"]), F.concat(
                    F.filter(acc["open"], lambda o: ~o["msg_id"].eqNullSafe(e["msg_id"])),
                    F.array(F.struct(e["msg_id"].alias("msg_id"), place.alias("opening"))))).otherwise(
                    acc["open"]).alias("open"),
                F.when(place.isNotNull(), F.concat(acc["done"], F.array(done))).otherwise(acc["done"]).alias("done"))
        # a list of one element binds the opening for all its uses
        opening = F.when(is_start, F.coalesce(live, e["at"])).otherwise(live)
        return F.get(F.transform(F.array(opening), act), F.lit(0))

    nothing = F.struct(
        F.array().cast("array<struct<lo:int,hi:int>>").alias("gone"),
        F.array().cast(f"array<struct<msg_id:{msg_type},opening:int>>").alias("open"),
        F.array().cast(f"array<struct<at:int,kind:string,msg_id:{msg_type},role:string,text:string,"
                       "opening:int>>").alias("done"))
    return F.aggregate(events, nothing, step, lambda acc: acc["done"])


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages of each conversation: conv_id, start (place of the
    opening event in the conversation's order), role, text.

    Null text is empty and null role "". Events of one seq are taken in the
    order start, edit, regenerate, delta, then by text and msg_id. An event
    for a message that is not there is ignored: never started, not started
    yet, or withdrawn by then. A start of a message that is there restarts it
    in its place with the new role; one of a withdrawn message opens it anew,
    at the place of that start. Null conv_id is a conversation of its own, as
    null msg_id is a message of its own. An empty log gives no rows.
    """
    rank = F.when(F.col("kind") == "start", 0).when(F.col("kind") == "edit", 1).when(
        F.col("kind") == "regenerate", 2).otherwise(3)
    log = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("")).alias("kind"), "msg_id",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), rank.alias("rank"))
    order = [F.col("seq").asc_nulls_first(), "rank", "text"]
    log = log.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order, "msg_id")))
    is_start, is_regenerate = F.col("kind") == "start", F.col("kind") == "regenerate"
    whole = Window.partitionBy("conv_id", "msg_id")
    log = log.withColumns({
        "starts": F.count(F.when(is_start, 1)).over(whole),
        "only_start": F.min(F.when(is_start, F.col("at"))).over(whole),
    }).where(F.col("starts") > 0)

    # whether a regeneration counts depends on those before it; so only these
    # events meet in one list a conversation, every other row stays a row
    contested = is_regenerate | (is_start & (F.col("starts") > 1))
    event = F.struct("at", "kind", "msg_id", "role", "text",
                     F.when(F.col("starts") == 1, F.col("only_start")).alias("only_start"))
    grouped = log.groupBy("conv_id", F.when(contested, 0).otherwise(F.col("at")).alias("slot")).agg(
        F.collect_list(event).alias("events"))
    as_is = F.transform("events", lambda e: F.struct(
        e["at"].alias("at"), e["kind"].alias("kind"), e["msg_id"].alias("msg_id"), e["role"].alias("role"),
        e["text"].alias("text"), F.when(e["kind"] == "start", e["at"]).alias("opening")))
    folded = _fold(F.array_sort("events"), log.schema["msg_id"].dataType.simpleString())
    log = grouped.select("conv_id", F.inline(F.when(F.col("slot") == 0, folded).otherwise(as_is)))

    so_far = Window.partitionBy("conv_id", "msg_id").orderBy("at")
    after = Window.partitionBy("conv_id").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    log = log.withColumn("withdrawn_from", F.min(F.when(is_regenerate, F.col("opening"))).over(after))
    log = log.withColumn("opening", F.last("opening", ignorenulls=True).over(so_far)).where(
        F.col("opening").isNotNull())
    message = Window.partitionBy("conv_id", "msg_id", "opening").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    log = log.withColumns({
        "final_role": F.last(F.when(is_start, F.col("role")), ignorenulls=True).over(message),
        # only what follows the last event that replaces the content remains
        "reset": F.max(F.when(F.col("kind").isin("start", "edit", "regenerate"), F.col("at"))).over(message),
        "cut": F.max(F.when(F.col("at") == F.col("opening"), F.col("withdrawn_from"))).over(message),
    }).where((F.col("cut").isNull() | (F.col("cut") >= F.col("opening"))) & (F.col("at") >= F.col("reset")))
    piece = F.struct("at", F.when(is_regenerate, F.lit("")).otherwise(F.col("text")).alias("text"))
    parts = F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"])
    return log.groupBy("conv_id", "msg_id", F.col("opening").alias("start"), F.col("final_role").alias("role")).agg(
        F.array_join(parts, "").alias("text")).select("conv_id", "start", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (code points, end exclusive, of the
    escaped assistant texts) of each conversation."""
    loss = F.col("role") == LOSS_ROLE
    body = escape(F.col("text"))
    turns = messages.select("conv_id", "start", loss.alias("loss"), F.when(
        loss, F.concat(F.lit("<s>"), body, F.lit("</s>"))).otherwise(
        F.concat(F.lit("[ROLE]"), escape(F.col("role")), F.lit("[INST]"), body, F.lit("[/INST]"))).alias("turn"))
    so_far = Window.partitionBy("conv_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("offset", F.coalesce(F.sum(F.length("turn")).over(so_far), F.lit(0)))
    span = F.struct((F.col("offset") + 3).alias("start"), (F.col("offset") + F.length("turn") - 4).alias("end"))
    rows = F.array_sort(F.collect_list(F.struct("start", "turn", F.when(F.col("loss"), span).alias("span"))))
    return turns.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id", F.array_join(F.transform("rows", lambda r: r["turn"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text, loss) of a formatted conversation."""
    def turn(t: Column) -> Column:
        loss = t.startswith("<s>")
        inner = F.regexp_replace(t, r"(?s)^<s>|</s>$|^\[ROLE\].*?\[INST\]|\[/INST\]$", "")
        role = F.substring_index(F.regexp_replace(t, r"^\[ROLE\]", ""), "[INST]", 1)
        return F.struct(F.when(loss, LOSS_ROLE).otherwise(unescape(role)).alias("role"),
                        unescape(inner).alias("text"), loss.alias("loss"))
    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


def format_chats(events: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans of each conversation of an event log;
    conversations whose messages were all withdrawn, and empty logs, give no
    row. A conversation is one output row and one training sample."""
    return render(reconstruct(events))


def turn_events(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each turn
    starts a message and streams its text as one delta. Turns of one number
    come in the order of role and text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).withColumn("msg_id", F.row_number().over(order))
    events = F.array(
        F.struct(F.lit("start").alias("kind"), F.lit(0).alias("step"), F.col("role").alias("r"), F.lit("").alias("t")),
        F.struct(F.lit("delta").alias("kind"), F.lit(1).alias("step"), F.lit("").alias("r"), F.col("text").alias("t")))
    return rows.select("conv_id", "msg_id", F.explode(events).alias("e")).select(
        "conv_id", (F.col("msg_id") * 2 + F.col("e.step")).alias("seq"), F.col("e.kind").alias("kind"), "msg_id",
        F.col("e.r").alias("role"), F.col("e.t").alias("text"))


def digests(formatted: DataFrame) -> DataFrame:
    """What reads back from the formatted output of each conversation."""
    read = formatted.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
