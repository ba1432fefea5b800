"""a clause scanner over query text: JOIN conditions, WHERE filters and CASE expressions.

A text is cut into tokens (comments, quoted strings and names, words, white space, single marks), of which only brackets, clause words
and ends count.  A fold over these few marks keeps a stack with one frame for each open bracket and CASE, so clauses of
a subquery, nested CASE expressions and words inside strings, quoted names and comments don't mix.  Everything is
built-in array functions: no Python runs, and a text is scanned once from left to right.

What a fact is: the text between its words as written, without comments and outer white space.  ``USING (id)`` is a join fact with its
word, and so is the ON of a MERGE; an ON without a JOIN or MERGE in its bracket (a grant, an index, ON CONFLICT) is none.  A CASE expression
is a fact from CASE to its own END, and nested ones are facts too.  WHERE counts wherever it stands (subqueries, FILTER), HAVING and QUALIFY
don't.  A clause that is still open at the end of the text ends there; an unfinished CASE gives nothing.  Strings
double their quotes (no backslash escapes) or stand between ``$$``; an unclosed string or comment reaches to the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JOIN = r"(?:INNER|(?:LEFT|RIGHT|FULL)(?:\s+(?:OUTER|SEMI|ANTI))?|SEMI|ANTI|ASOF)\s+(?:LATERAL\s+)?JOIN\b|JOIN\b"
_CROSS = r"CROSS\s+JOIN\b|NATURAL\s+(?:(?:INNER|(?:LEFT|RIGHT|FULL)(?:\s+OUTER)?)\s+)?JOIN\b"
_STOP = (r"(?:GROUP|ORDER|SORT|CLUSTER|DISTRIBUTE|CONNECT)\s+BY\b|START\s+WITH\b|LATERAL\s+VIEW\b|HAVING\b|WINDOW\b|QUALIFY\b|LIMIT\b|OFFSET\b|FETCH\b|UNION\b"
         r"|INTERSECT\b|EXCEPT\b|MINUS\b|RETURNING\b|WHEN\b|SET\b|WHERE\b|FOR\s+UPDATE\b")
_WORD = r"(?:CASE|END|ON|USING|MERGE)\b"
_CLAUSE = rf"(?:{_CROSS}|{_JOIN}|{_STOP}|{_WORD})"
#: A run without any clause word, bracket or quote is one token (a possessive loop, which Java runs without recursion); a dotted name is one word,
#: so ``t.order`` is no clause.
_PLAIN = rf"(?:(?!{_CLAUSE}|\$\$)[\w$.]+|\s+|[^\w\s'\"`(),;$.\-/]|-(?!-)|/(?!\*))++"
TOKEN = (r"(?is)--[^\n]*|/\*.*?(?:\*/|$)|\$\$.*?(?:\$\$|$)|'[^']*(?:'|$)|\"[^\"]*(?:\"|$)|`[^`]*(?:`|$)"
         rf"|{_CLAUSE}|{_PLAIN}|.")

_FRAME = "struct<open: string, kind: string, start: int, joins: int>"
_FACT = "struct<kind: string, first: int, last: int>"


def _frame(open_: Column, kind: Column, start: Column, joins: Column) -> Column:
    return F.struct(open_.cast("string").alias("open"), kind.cast("string").alias("kind"), start.cast("int").alias("start"), joins.cast("int").alias("joins"))


def _mark(token: Column, i: Column) -> Column:
    """What a token does, at its place; null for the tokens that do nothing."""
    word = F.upper(token)
    clause = (F.when(word.isin("CASE", "END", "ON", "USING", "WHERE", "MERGE"), F.lower(token))
              .when(word.rlike(rf"^(?:{_JOIN})$"), F.lit("join")).otherwise(F.lit("stop")))
    what = F.when(token.isin("(", ")", ",", ";"), token).when(token.rlike(rf"(?i)^{_CLAUSE}$"), clause)
    return F.struct(what.alias("what"), i.cast("int").alias("at"))


def _step(state: Column, mark: Column) -> Column:
    """The scanner's state after a mark: the stack of open brackets and CASEs (the last is the innermost), and the facts so far."""
    stack, facts, what, at = state["stack"], state["facts"], mark["what"], mark["at"]
    none, null = F.array().cast(f"array<{_FACT}>"), F.lit(None)
    top, below = F.element_at(stack, -1), F.slice(stack, F.lit(1), F.size(stack) - 1)
    in_case = top["open"] == "case"

    def fact(frame: Column, last: Column) -> Column:
        return F.struct(frame["kind"].alias("kind"), frame["start"].alias("first"), last.cast("int").alias("last"))

    def closed(frame: Column, last: Column) -> Column:
        return F.when(frame["kind"].isNotNull() & (frame["open"] != "case"), F.array(fact(frame, last))).otherwise(none)

    def with_top(kind: Column, start: Column, joins: Column) -> Column:
        return F.concat(below, F.array(_frame(top["open"], kind, start, joins)))

    merging, free = top["joins"] < 0, top["joins"] > 0
    plain = with_top(null, null, top["joins"])
    on, using = (what == "on") & (top["joins"] != 0), (what == "using") & (free | merging)
    comma = (what == ",") & (top["kind"] == "join")
    ends = what.isin("stop", "where", "join", "merge") | on | using | comma
    fewer = F.greatest(F.abs(top["joins"]) - 1, F.lit(0))
    new_stack = (
        F.when(what == "(", F.concat(stack, F.array(_frame(F.lit("("), null, null, F.lit(0)))))
        .when(what == "case", F.concat(stack, F.array(_frame(F.lit("case"), F.lit("case"), at, F.lit(0)))))
        .when(what == ";", F.array(_frame(F.lit(";"), null, null, F.lit(0))))
        .when((what == ")") & (top["open"] == "("), below)
        .when((what == "end") & in_case, below)
        .when(in_case, stack)
        .when(what == "join", with_top(null, null, F.greatest(top["joins"], F.lit(0)) + 1))
        .when(what == "merge", with_top(null, null, F.lit(-1)))
        .when(on, with_top(F.lit("join"), at + 1, fewer))
        .when(using & free, with_top(F.lit("join"), at, fewer))
        .when(what == "where", with_top(F.lit("filter"), at + 1, top["joins"]))
        .when((what == "stop") | using | comma, plain)
        .otherwise(stack))
    every = F.flatten(F.transform(stack, lambda f: closed(f, at - 1)))
    new_facts = (
        F.when(what == ";", every)
        .when((what == ")") & (top["open"] == "("), closed(top, at - 1))
        .when((what == "end") & in_case, F.array(fact(top, at)))
        .when(~in_case & ends, closed(top, at - 1))
        .otherwise(none))
    may_end = what.isin(";", ")", "end") | (~in_case & ends)
    return F.struct(new_stack.alias("stack"), F.when(may_end, F.concat(facts, new_facts)).otherwise(facts).alias("facts"))


def clause_facts(text: Column) -> Column:
    """Array of (kind, fact) of a query text: kinds ``join``, ``filter`` and ``case``; null for a null text."""
    tokens = F.concat(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.array(F.lit(";")))
    # bound as a lambda's variable, so that the text is cut into tokens once
    return F.element_at(F.transform(F.array(tokens), _facts), 1)


def _facts(tokens: Column) -> Column:
    marks = F.filter(F.transform(tokens, _mark), lambda m: m["what"].isNotNull())
    start = F.struct(F.array(_frame(F.lit(";"), F.lit(None), F.lit(None), F.lit(0))).alias("stack"), F.array().cast(f"array<{_FACT}>").alias("facts"))
    facts = F.aggregate(marks, start, _step, lambda s: s["facts"])

    def worded(f: Column) -> Column:
        part = F.filter(F.slice(tokens, f["first"] + 1, F.greatest(f["last"] - f["first"] + 1, F.lit(0))),
                        lambda t: ~t.startswith("--") & ~t.startswith("/*"))
        return F.struct(f["kind"].alias("kind"), F.regexp_replace(F.array_join(part, ""), r"^\s+|\s+$", "").alias("fact"))

    return F.filter(F.transform(facts, worded), lambda f: f["fact"] != "")
