"""Robots policy expressions over one robots text per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Only \n ends a line; carriage returns are stripped as white space.
_BLANK = r"[^\S\n]*"
_AGENT_LINE = rf"(?mdi)^{_BLANK}user-agent:"
_FULL_BLOCK = rf"(?mdi)^{_BLANK}disallow:{_BLANK}/{_BLANK}$"
# A section that names an agent and states no rule is merged into the next one.
_HAS_RULE = rf"(?mdi)^{_BLANK}(?:dis)?allow:"


def _sections(content: Column) -> Column:
    """The text after each ``User-agent:``; element 0 of the split precedes the first."""
    parts = F.split(content, _AGENT_LINE)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def _agent(section: Column) -> Column:
    return strip(F.substring_index(section, "\n", 1))


def _rules(section: Column) -> Column:
    return F.when(F.instr(section, "\n") > 0, F.substr(section, F.instr(section, "\n"))).otherwise("")


def blocked_agents(content: Column, grouped: bool = False) -> Column:
    """Names of the agents for which the whole site is disallowed.

    A rule counts for the nearest ``User-agent`` line above it only; with
    ``grouped``, for all consecutive ``User-agent`` lines above it. The text is
    cut at its agent lines, so one row is enough and nothing is shuffled.
    """
    named = F.transform(
        _sections(F.coalesce(content, F.lit(""))),
        lambda s: F.struct(
            _agent(s).alias("agent"),
            _rules(s).rlike(_FULL_BLOCK).alias("blocks"),
            _rules(s).rlike(_HAS_RULE).alias("rules"),
        ),
    )
    if grouped:
        # The verdict of the first later section with rules holds for the group.
        def verdict(x: Column, i: Column) -> Column:
            later = F.filter(F.slice(named, i + 1, F.size(named)), lambda y: y["rules"])
            blocks = F.coalesce(F.get(later, F.lit(0))["blocks"], F.lit(False))
            return F.struct(x["agent"].alias("agent"), blocks.alias("blocks"))

        named = F.transform(named, verdict)
    hits = F.filter(named, lambda x: x["blocks"] & (x["agent"] != ""))
    return F.array_distinct(F.transform(hits, lambda x: x["agent"]))


# A rule of a group, without what follows a "#"; blanks may stand around the colon.
_RULE = rf"(?mdi)^{_BLANK}(allow|disallow|crawl-delay){_BLANK}:([^\n#]*+)"


def rule_groups(content: Column) -> Column:
    """The rules of every agent line: array<struct<agent, rules: array<struct<directive, value>>>>, agents in lower case.

    Consecutive agent lines share the rules that follow the last of them. A rule
    without value says nothing, but ends the agent lines above it. An agent that
    is named several times has an element for each.
    """
    named = F.transform(
        _sections(F.coalesce(content, F.lit(""))),
        lambda s: F.struct(
            F.lower(strip(F.substring_index(_agent(s), "#", 1))).alias("agent"),
            F.transform(
                F.regexp_extract_all(_rules(s), F.lit(_RULE), F.lit(0)),
                lambda r: F.struct(
                    F.lower(F.regexp_extract(r, _RULE, 1)).alias("directive"), strip(F.regexp_extract(r, _RULE, 2)).alias("value")
                ),
            ).alias("rules"),
        ),
    )

    def shared(x: Column, i: Column) -> Column:
        later = F.filter(F.slice(named, i + 1, F.size(named)), lambda y: F.size(y["rules"]) > 0)
        own = F.filter(F.get(later, F.lit(0))["rules"], lambda r: r["value"] != "")
        return F.struct(x["agent"].alias("agent"), F.coalesce(own, F.array().cast(_RULES)).alias("rules"))

    return F.filter(F.transform(named, shared), lambda g: g["agent"] != "")


_RULES = "array<struct<directive:string,value:string>>"


def rules_for(groups: Column, agent: str) -> Column:
    """The rules that hold for one agent: those of its groups, or of ``*`` where it has none."""
    own = F.filter(groups, lambda g: g["agent"] == agent.lower())
    chosen = F.when(F.size(own) > 0, own).otherwise(F.filter(groups, lambda g: g["agent"] == "*"))
    return F.flatten(F.transform(chosen, lambda g: g["rules"]))


def _matches(path: Column, value: Column) -> Column:
    """Does a path begin as a rule says? ``*`` stands for any signs, a last ``$`` for the end."""
    closed = value.endswith("$")
    body = F.when(closed, F.substr(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    pattern = F.replace(F.regexp_replace(body, r"([^\w/*%-])", r"\\$1"), F.lit("*"), F.lit(".*"))
    pattern = F.concat(F.lit("(?s)^"), pattern, F.when(closed, F.lit("$")).otherwise(F.lit("")))
    return F.when(closed | F.contains(value, F.lit("*")), F.rlike(path, pattern)).otherwise(path.startswith(value))


def path_allowed(rules: Column, path: Column) -> Column:
    """May a path be fetched? The longest matching rule decides, of equally long ones the one that allows; no rule allows."""
    of_paths = F.filter(rules, lambda r: r["directive"] != "crawl-delay")
    met = F.filter(of_paths, lambda r: _matches(path, r["value"]))
    told = F.transform(met, lambda r: F.struct(F.length(r["value"]).alias("n"), (r["directive"] == "allow").alias("allow")))
    return F.coalesce(F.array_max(told)["allow"], F.lit(True))
