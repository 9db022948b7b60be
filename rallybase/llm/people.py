"""Licence holders as a registry, and the link from typed names to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.licences import _majority, read_licences
from ..operators.skew import add_salt, hot_keys, replicate
from ..session import stash
from . import names as N

#: What stands for a missing player.
PLACEHOLDERS = r"(?i)^\W*(vakant|vacant|wo|w\.?o\.?|reserv\w*|bye|tba|tbd|okänd|okänd spelare|n\.?n\.?|x+|-+|\?+|fri|spelare [0-9ab]*|lag [0-9ab]*)\W*$"

KNOWN = 0.0005  # this share of all persons, and no less than three, makes a part of a name a name of its own
OTHER_NAME = 0.1  # what is left of the weight where a name of its own would have to be an error
HOT = 0.0005  # forms with more than this share of the index are spread over slices
WHOLE = 0.81  # rewritings above this change no letter: order, nicknames, left-out parts
NEAR = 0.62  # least nearness of a spelling to the person of its group, with which it shares a fifth of the name


def registry(raw: DataFrame, clubs: DataFrame, extra_clubs: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """licences (read, with club_id), persons (person, registered, firstname, lastname, year), spellings (person, firstname,
    lastname), club_of (text, club_id). Registered is the spelling of the licence row with the lowest row_id."""
    lic = stash(read_licences(raw), "licences")
    texts = lic.select(F.col("club_name").alias("text")).distinct()
    club_of = stash(N.resolve_clubs(texts.unionByName(extra_clubs.select("text").distinct()) if extra_clubs is not None else texts, clubs).select("text", "club_id"), "clubof")
    by_number = _majority(lic.join(club_of, lic["club_name"] == club_of["text"]), ["club"], "club_id", "_id1")
    lic = lic.join(by_number, "club", "left").join(club_of.select(F.col("text").alias("club_name"), F.col("club_id").alias("_id2")), "club_name", "left")
    lic = stash(lic.withColumn("club_id", F.coalesce("_id1", "_id2")).drop("_id1", "_id2"), "licences2")
    held = lic.filter(F.col("person").isNotNull() & F.col("firstname").isNotNull() & F.col("lastname").isNotNull())
    first = held.groupBy("person").agg(F.min_by(F.struct("firstname", "lastname"), "row_id").alias("n"))
    usual = held.groupBy("person", "name_key", "firstname", "lastname").agg(F.count(F.lit(1)).alias("k")).groupBy("person").agg(F.max_by(F.struct("firstname", "lastname"), F.struct("k", "name_key", "firstname")).alias("n"))
    years = _majority(lic.filter("person is not null"), ["person"], "year", "year")
    persons = first.select("person", F.concat_ws(" ", "n.firstname", "n.lastname").alias("registered")).join(usual.select("person", F.col("n.firstname").alias("firstname"), F.col("n.lastname").alias("lastname")), "person").join(years, "person", "left")
    spellings = first.unionByName(usual).select("person", "n.firstname", "n.lastname").distinct()
    return lic, stash(persons, "persons"), spellings, club_of


def registered_index(spellings: DataFrame) -> DataFrame:
    """form, person: the persisted side of the join."""
    return stash(N.explode_forms(spellings, ["person"], ["firstname", "lastname"], N.registered_forms, False).distinct(), "forms")


def known_parts(spellings: DataFrame, share: float = KNOWN) -> DataFrame:
    """part: folded parts of names that a share of all persons have, so that it is a name of its own and no error for another."""
    own = spellings.select("person", F.explode(_parts(F.concat_ws(" ", "firstname", "lastname"))).alias("part")).distinct()
    every = spellings.agg(F.countDistinct("person").alias("_all"))  # one row
    return own.groupBy("part").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(every), F.col("n") >= F.greatest(F.lit(3.0), F.col("_all") * share)).select("part")


def _parts(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(X.fold(c), r"(.)\1+", "$1"), " "), lambda t: F.length(t) > 1)


def candidates(typed: DataFrame, index: DataFrame, spellings: DataFrame) -> DataFrame:
    """name_id, person, told (weight of the best shared form, by its rarity), weight.

    A rewriting that turns a part which is a name of its own into another one counts a tenth.

    typed: name_id and name, distinct. Every name is searched with all its forms, also one that is a holder's own: it may be a
    misspelling of another's. Every person that shares a form is a candidate, however common the form; the persons of hot forms
    are spread over slices, and the typed names are repeated in each."""
    names = typed.select("name_id", "name").distinct()
    made = N.explode_forms(names, ["name_id"], ["name"], N.typed_forms, True)
    hot = hot_keys(index, ["form"], HOT)
    spread = add_salt(index, hot, ["form"], [F.col("person")])
    met = replicate(made, hot, ["form"]).hint("merge").join(spread, ["form", "_salt"]).select("name_id", "person", "weight")
    found = met.groupBy("name_id", "person").agg(F.max("weight").alias("weight"))
    known = known_parts(spellings)
    typed_parts = names.select("name_id", F.explode(_parts(F.col("name"))).alias("part")).join(known, "part").groupBy("name_id").agg(F.collect_set("part").alias("_known"))  # at most six parts
    person_parts = spellings.groupBy("person").agg(F.array_distinct(F.flatten(F.collect_list(_parts(F.concat_ws(" ", "firstname", "lastname"))))).alias("_own"))  # two spellings
    found = found.join(typed_parts, "name_id", "left").join(person_parts, "person", "left")
    other = F.size(F.array_except(F.coalesce("_known", F.array().cast("array<string>")), F.coalesce("_own", F.array().cast("array<string>")))) > 0
    found = found.select("name_id", "person", F.when(other & (F.col("weight") < WHOLE), F.col("weight") * OTHER_NAME).otherwise(F.col("weight")).alias("weight"))
    w = Window.partitionBy("name_id").orderBy(F.desc("weight")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    told = F.col("weight") / (1 + 0.15 * F.log(F.count(F.lit(1)).over(w).cast("double")))
    return found.select("name_id", "person", told.alias("told"), F.col("weight").cast("double").alias("weight"))


def link_names(rows: DataFrame, persons: DataFrame, spellings: DataFrame, person_clubs: DataFrame, least: float = 0.72) -> DataFrame:
    """row_id, person, score for every row whose name can be told to be a holder's.

    rows: row_id, name, club_id (null if unknown), grp (a number: rows of one grp are about one person; null: alone). A
    candidate's score is what its rewriting tells plus the club's agreement; the candidates of a group are summed over its
    spellings, the best one is the group's person if it is ahead of the second. Null, empty and placeholder names give no row.
    """
    rows = rows.filter(F.col("name").isNotNull() & ~F.col("name").rlike(PLACEHOLDERS) & (F.trim("name") != ""))
    rows = rows.withColumn("name_id", F.xxhash64("name")).withColumn("grp", F.coalesce("grp", F.xxhash64("name", F.coalesce("club_id", F.lit(-1)))))
    units = stash(rows.groupBy("name_id", "club_id", "grp").agg(F.any_value("name").alias("name")), "units")
    pairs = candidates(units.select("name_id", "name"), registered_index(spellings), spellings)
    pairs = stash(pairs, "pairs")
    at_club = person_clubs.withColumn("_at", F.lit(True))
    scored = units.select("name_id", "club_id", "grp").join(pairs, "name_id").join(at_club, ["person", "club_id"], "left")
    club = F.when(F.col("_at"), 0.6).when(F.col("club_id").isNull(), 0.0).otherwise(-0.25)
    scored = stash(scored.select("name_id", "grp", "person", (F.col("told") + club).alias("score")), "scored")
    totals = scored.groupBy("grp", "person").agg(F.sum("score").alias("total"), F.max("score").alias("best"))
    w = Window.partitionBy("grp").orderBy(F.desc("total"), "person")
    top = totals.withColumn("_r", F.row_number().over(w)).withColumn("_second", F.lead("total").over(w)).filter("_r = 1")
    who = top.filter((F.col("best") >= least) & (F.col("total") > F.coalesce("_second", F.lit(-1.0)) + 0.05)).select("grp", "person", "best")
    mine = units.groupBy("name_id", "grp").agg(F.any_value("name").alias("name")).join(who, "grp")
    own = scored.groupBy("name_id", "grp", "person").agg(F.max("score").alias("score"))
    mine = stash(mine.join(own, ["name_id", "grp", "person"], "left").join(persons.select("person", "registered"), "person"), "mine")
    sure = F.col("best") >= 1.0
    linked = mine.filter(F.col("score").isNotNull() & ((F.col("score") >= 0.3) | sure)).select("name_id", "grp", "person", "score")
    # What shares no form with the sure person of its group is met by the fifths of that person's name.
    rest = mine.filter(F.col("score").isNull() & sure).select("name_id", "grp", "person", "name", "registered")
    typed = N.explode_forms(rest, ["name_id", "grp", "person"], ["name"], N.typed_pieces, False)
    held = N.explode_forms(rest.select("grp", "person", "registered").distinct(), ["grp", "person"], ["registered"], N.registered_pieces, False)
    met = typed.join(held, ["grp", "person", "form"]).select("name_id", "grp", "person").distinct().join(rest, ["name_id", "grp", "person"])
    met = met.filter(X.nearness(X.token_key(F.col("name")), X.token_key(F.col("registered"))) >= NEAR)
    linked = linked.unionByName(met.select("name_id", "grp", "person", F.lit(0.0).alias("score")))
    return rows.select("row_id", "name_id", "grp").join(linked, ["name_id", "grp"]).select("row_id", "person", "score")
