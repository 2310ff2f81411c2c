"""Statements of an entity store's JSON (SRC12) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STATEMENTS = "array<struct<rank:string,mainsnak:struct<snaktype:string,datavalue:struct<value:struct<id:string>>>>>"


def best_ranked(claims: Column, prop: str) -> Column:
    """Items of a property's best statements, each once, in order: preferred ones if there are any, else normal ones; deprecated ones and those without a value never count. claims: JSON."""

    def of(all_: Column) -> Column:
        good = F.filter(F.coalesce(all_, F.array().cast(_STATEMENTS)), lambda s: (F.coalesce(s["rank"], F.lit("normal")) != "deprecated") & (s["mainsnak"]["snaktype"] == "value"))
        return F.element_at(F.transform(F.array(good), chosen), 1)

    def chosen(good: Column) -> Column:
        some = F.exists(good, lambda s: s["rank"] == "preferred")
        best = F.filter(good, lambda s: ~some | (s["rank"] == "preferred"))
        ids = F.transform(best, lambda s: s["mainsnak"]["datavalue"]["value"]["id"])
        return F.array_distinct(F.filter(ids, lambda x: x.startswith("Q")))

    return F.element_at(F.transform(F.array(F.from_json(F.get_json_object(claims, f"$.{prop}"), _STATEMENTS)), of), 1)
