"""Matching people across sources without a common key: many votes on each candidate, weighed by a label model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stash
from . import names as N
from . import people
from .labelmodel import with_confidence

VOTERS = ["v_exact", "v_form", "v_last", "v_first", "v_year", "v_from", "v_to", "v_move"]
#: First guess of the weights, before anything is learned.
START = {"v_exact": 1.0, "v_form": 1.5, "v_last": 1.0, "v_first": 0.7, "v_year": 1.5, "v_from": 1.2, "v_to": 1.2, "v_move": 1.0, "": 2.0}


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def link_transitions(transitions: DataFrame, licences: DataFrame, clubs: DataFrame, least: float = 0.5) -> DataFrame:
    """row_id, person, confidence: for every transition its person, null if nobody reaches the least confidence.

    Candidates share a canonical form of the name (or the year and the club left); each gets votes on name, first and last
    part, year, the club left, the club joined and the change of club in that season. A row has at
    most one person, the one with the highest confidence if no other is as high. Null fields abstain; rows without a name
    have no candidates by name; repeated rows are linked each."""
    extra = transitions.select(F.col("club_from").alias("text")).unionByName(transitions.select(F.col("club_to").alias("text")))
    lic, persons, spellings, club_of = people.registry(licences, clubs, extra)
    season = F.coalesce(X.season_start(F.col("season_label")), F.year(F.add_months("transition_date", -6)))
    t = transitions.select("row_id", F.concat_ws(" ", "firstname", "lastname").alias("name"), F.col("firstname").alias("t_first"), F.col("lastname").alias("t_last"), season.alias("season"), F.year("date_born").alias("y1"), X.year_of(F.col("year_born")).alias("y2"), F.col("club_from").alias("_f"), F.col("club_to").alias("_t"))
    t = t.join(club_of.select(F.col("text").alias("_f"), F.col("club_id").alias("from_id")), "_f", "left").join(club_of.select(F.col("text").alias("_t"), F.col("club_id").alias("to_id")), "_t", "left").drop("_f", "_t")
    bare = lambda c: F.regexp_replace(X.fold(F.col(c)), " ", "")
    t = stash(t.withColumns({"name_id": F.xxhash64("name"), "t_key": X.token_key(F.col("name")), "t_first": bare("t_first"), "t_last": bare("t_last")}), "t")
    held = lic.filter("person is not null and club_id is not null and season is not null").select("person", "season", "club_id").distinct()
    held = stash(held, "held")
    person_clubs = held.select("person", "club_id").distinct()
    index = people.registered_index(spellings)
    by_name = stash(people.candidates(t, index, spellings), "byname")
    years = t.select("row_id", F.explode(F.array_compact(F.array_distinct(F.array("y1", "y2")))).alias("year"), F.col("from_id").alias("club_id")).filter("club_id is not null")
    by_club = years.join(persons.select("person", "year").join(person_clubs, "person"), ["year", "club_id"]).select("row_id", "person")
    pairs = t.join(by_name, "name_id").select("row_id", "person", "told", "weight").unionByName(by_club.withColumn("told", F.lit(None).cast("double")).withColumn("weight", F.lit(None).cast("double")))
    pairs = pairs.groupBy("row_id", "person").agg(F.max("told").alias("told"), F.max("weight").alias("weight"))
    seasons = held.groupBy("person").agg(F.collect_set(F.struct("season", "club_id")).alias("held"))  # bounded: seasons x clubs of one person
    # Names are folded once for each row and person, never for each pair.
    folded = persons.select("person", "year", X.token_key(F.concat_ws(" ", "firstname", "lastname")).alias("key"), bare("firstname").alias("first"), bare("lastname").alias("last"))
    full = pairs.join(t, "row_id").join(folded, "person").join(seasons, "person", "left")
    at = lambda when, club: F.exists("held", lambda h: when(h["season"]) & (h["club_id"] == F.col(club)))
    s = F.col("season")
    near = lambda a, b: X.nearness(F.col(a), F.col(b))
    near_last = F.coalesce(F.greatest(near("t_last", "last"), near("t_first", "last")), F.lit(0.0))
    near_first = F.coalesce(F.greatest(near("t_last", "first"), near("t_first", "first")), F.lit(0.0))
    year_met = F.coalesce(F.col("y1") == F.col("year"), F.lit(False)) | F.coalesce(F.col("y2") == F.col("year"), F.lit(False))
    year_off = F.coalesce(F.least(F.abs(F.col("y1") - F.col("year")), F.abs(F.col("y2") - F.col("year"))), F.lit(-1))
    before, after = at(lambda y: (y <= s) & (y >= s - 3), "from_id"), at(lambda y: (y >= s) & (y <= s + 2), "to_id")
    known_before = F.exists("held", lambda h: h["season"] < s) & F.col("from_id").isNotNull()
    known_after = F.exists("held", lambda h: h["season"] >= s) & F.col("to_id").isNotNull()
    voted = full.withColumns(
        {
            "v_exact": _vote(F.col("t_key") == F.col("key"), F.coalesce(F.col("weight"), F.lit(0.0)) < 0.5),
            "v_form": _vote(F.col("weight") >= 0.7, F.col("weight").isNull()),
            "v_last": _vote(near_last >= 0.8, near_last < 0.6),
            "v_first": _vote((near_first >= 0.7) | (F.col("weight") >= 0.7), (near_first < 0.4) & F.col("weight").isNull()),
            "v_year": _vote(year_met, year_off > 1),
            "v_from": _vote(F.coalesce(before, F.lit(False)), F.coalesce(known_before & ~before, F.lit(False))),
            "v_to": _vote(F.coalesce(after, F.lit(False)), F.coalesce(known_after & ~after, F.lit(False))),
            "v_move": _vote(F.coalesce(before & after, F.lit(False)), F.coalesce(known_before & known_after & ~before & ~after, F.lit(False))),
        }
    )
    votes = stash(voted.select("row_id", "person", "told", *VOTERS), "votes")  # made once: to learn from, and to be judged
    told = with_confidence(votes, VOTERS, start=START)
    w = Window.partitionBy("row_id").orderBy(F.desc("confidence_odds"), F.desc_nulls_last("told"), "person")
    best = told.withColumn("_r", F.row_number().over(w)).withColumn("_c", F.lead("confidence_odds").over(w)).withColumn("_t", F.lead("told").over(w)).filter("_r = 1")
    alone = F.col("_c").isNull() | (F.col("confidence_odds") > F.col("_c") + 0.1) | (F.coalesce("told", F.lit(0.0)) > F.coalesce("_t", F.lit(0.0)))
    agreed = (F.col("v_form") >= 0) & (F.col("v_year") + F.col("v_from") + F.col("v_to") + F.col("v_move") >= 1) | (F.col("v_exact") == 1) & (F.col("v_year") >= 0) & (F.col("v_from") + F.col("v_to") >= 0) | (F.col("v_move") == 1) & (F.col("v_year") == 1) & ((F.col("v_last") == 1) | (F.col("v_first") == 1) & (F.col("v_last") >= 0))
    found = best.filter((F.col("confidence") >= least) & alone & agreed).select("row_id", "person", "confidence", *VOTERS)
    return t.select("row_id").join(found, "row_id", "left")
