"""Text of messages and pages: tags, contents, system messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import local_iso_time


def strip_tags(c: Column, tags: list[str]) -> Column:
    """Without the elements of these names, contents too."""
    return reduce(lambda x, t: F.regexp_replace(x, rf"(?s)<{t}[^>]*>.*?</{t}>", ""), tags, c)


def contains_any(c: Column, parts: list[str], ignore_case: bool = False) -> Column:
    text = F.lower(c) if ignore_case else c
    return reduce(lambda x, p: x | F.coalesce(text.contains(p.lower() if ignore_case else p), F.lit(False)), parts, F.lit(False))


def allowed(c: Column, allow: list[str], deny: list[str]) -> Column:
    """Holds an allowed word and no denied one, whatever the case."""
    return contains_any(c, allow, True) & ~contains_any(c, deny, True)


def content_text(c: Column) -> Column:
    """Text of a message content: a JSON string, or the parts of type text or input_text of a JSON list, a line each. What is no JSON is text."""
    parts = F.from_json(c, "array<struct<type:string,text:string>>", {"mode": "PERMISSIVE"})
    listed = F.array_join(F.transform(F.filter(parts, lambda p: p["type"].isin("text", "input_text")), lambda p: F.coalesce(p["text"], F.lit(""))), "\n")
    is_list = F.ltrim(c).startswith("[") & F.try_parse_json(c).isNotNull()
    return F.when(is_list, listed).otherwise(F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v"), c))


#: Elements of messages that are not the writer's own words, and passages that mark a message as made by a program. Fixed values.
TAGS = [
    "image", "filesystem", "permission_profile", "current_date", "timezone", "workspace_roots", "file_system", "entry", "root", "special", "path",
    "access", "truncated", "guardian_truncated", "ide_opened_file", "local-command-caveat", "local-command-stdout", "command-name",
    "command-message", "command-args", "task-notification", "recommended_plugins", "cwd", "shell", "subagents",
]
MARKERS = [
    "# AGENTS.md instructions", "<INSTRUCTIONS>", "The following is the Codex agent history", ">>> RETAINED USER INSTRUCTIONS", ">>> TRUSTED USER ANSWERS",
    ">>> TRANSCRIPT DELTA", "<external_codex_apps_open_page>", "<hook_prompt", "<permissions instructions>", "</permissions instructions>",
    "This is a request to approve", "You are being asked to approve", "Please confirm that you want to run", "The user would like you to",
    "We need your permission", "Press Enter to continue", "Distinguish instructions in attached documents", "## My request:",
    "# Files mentioned by the user:", "You are judging one planned coding-agent action", "Assess the exact action", "Base Risk Taxonomy", "Outcome Policy",
    "# Security Policy", "# Evidence Handling", "You may use read-only tool checks", "For low-risk actions, give the final answer directly",
]


def message_text(c: Column, tags: list[str] = TAGS) -> Column:
    """A message's own words."""
    return F.trim(strip_tags(F.regexp_replace(c, "</?environment_context>", ""), tags))


def is_system(c: Column, markers: list[str] = MARKERS) -> Column:
    """Blank, or made by a program."""
    return (F.trim(F.coalesce(c, F.lit(""))) == "") | contains_any(c, markers)


def own_messages(df: DataFrame, text: str, ts: str, least: int = 2, most: int = 800) -> DataFrame:
    """Messages that people wrote, with a time and `least` letters at least, shortened to `most`."""
    out = df.withColumn(text, message_text(F.col(text))).where(~is_system(F.col(text)) & (F.length(text) >= least) & F.col(ts).isNotNull())
    return out.withColumn(text, F.left(text, F.lit(most)))


def messages_by_day(df: DataFrame, ts: str, zone: str = "Asia/Shanghai") -> DataFrame:
    """(day, n): messages of each local day; ts is text in ISO form or a timestamp in UTC."""
    return df.groupBy(F.to_date(local_iso_time(F.col(ts).cast("string"), zone)).alias("day")).agg(F.count("*").alias("n")).where("day is not null")
