"""Entities that are kept while records arrive in batches.

What is kept are four tables in the shared scratch folder: profiles (the distinct values seen, with one id and the number
of their records), members (each record's profile), components (a star forest over profiles) and the best probability of each
linked profile. A batch is compared with itself and with the kept profiles, its links are moved to
the roots of the components they touch, and only these are merged. Earlier links are never read again, pairs of earlier
records never compared again. After any sequence of batches the entities and probabilities are those of one
``resolve`` over all records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_THRESHOLD, PROB_COL
from ..errors import MatchError
from ..functions.similarity import check_unit
from ..model import Model
from ..operators.blocking import DEFAULT_BLOCK_SPLIT, block_maxima, stack_rules
from ..operators.clusters import best_match_probability
from ..operators.components import connected_components, extend_components
from ..operators.dense import reachable_pairs
from ..operators.scoring import compare_pairs, link_pairs, prune_unreachable, score_pairs
from ..session import release, write_table
from .resolve import check_inputs, internal_model, positional, profile_states, read_model, require_columns, slim_rows
from .score import KnownRecords, stack

ENTITY = "entity"


class KeptEntities:
    """``add`` batches of records, read ``entities`` at any time.

    ``model`` is a :class:`Model`, its JSON or dict, with blocking rules (rules of near values are for ``resolve``).
    Batches need the model's columns and ``id_col``, whose values are unique over all batches; other columns are ignored.
    """

    def __init__(self, model: Model | str | dict, *, id_col: str, threshold: float = DEFAULT_THRESHOLD, unit: str = "byte",
                 within: Sequence[str] = (), block_split: int | None = DEFAULT_BLOCK_SPLIT):
        self.model = read_model(model, None) if not isinstance(model, Model) else model
        if self.model.near:
            raise MatchError("rules of near values are for resolve; keep entities by blocking rules")
        check_unit(unit)
        self.id_col, self.threshold, self.unit, self.block_split = id_col, float(threshold), unit, block_split
        self.own, self.names, self.within = internal_model(self.model, within)
        self.needed = list(self.names)
        self.keys = list(self.names.values())
        self.members: list[DataFrame] = []
        self.tables: dict[str, tuple[DataFrame, str]] = {}

    def _keep(self, **tables: DataFrame) -> None:
        """Write the new state, then delete the one that it replaces."""
        new = {name: write_table(df, f"kept-{name}") for name, df in tables.items()}
        old = [folder for _, folder in self.tables.values()]
        self.tables = new
        if old:
            release(next(iter(new.values()))[0].sparkSession, old)

    def _links(self, fresh: DataFrame) -> DataFrame:
        """Links of new profiles among themselves and with the kept ones."""
        maxima = block_maxima(stack_rules(fresh, self.own.rules, id_col="pid", within=self.within), len(self.own.rules))
        pairs = reachable_pairs(
            fresh, self.own.rules, self.own, self.threshold, id_col="pid", within=self.within, carry=self.own.columns, unit="char",
            block_split=self.block_split, maxima=maxima,
        )
        pairs = prune_unreachable(pairs, self.own, self.threshold, unit="char")
        links = link_pairs(score_pairs(compare_pairs(pairs, self.own, unit="char"), self.own), self.threshold).select("uid_l", "uid_r", PROB_COL)
        if not self.tables:
            return links
        known = KnownRecords(self.tables["profiles"][0], self.own, "pid", self.within, "char", self.block_split)
        return links.unionByName(known.links(stack(fresh, self.own, "pid", self.within, "char"), self.threshold).select("uid_l", "uid_r", PROB_COL))

    def add(self, batch: DataFrame) -> KeptEntities:
        """Take in a batch of new records (an empty one changes nothing)."""
        require_columns(batch, [*self.needed, self.id_col])
        if batch.isEmpty():
            return self
        check_inputs(batch, self.needed, self.threshold, self.id_col, True)
        rows = positional(batch).withColumn("uid", F.col(f"p{batch.columns.index(self.id_col)}"))
        # 128 bits tell the values apart (NULLs are left out of the JSON)
        digest = F.unhex(F.md5(F.to_json(F.struct(*self.keys)))).alias("digest")
        slim = slim_rows(rows, batch.columns, self.model, self.names, self.unit).select("uid", digest, *self.keys)
        for earlier in self.members:
            if not slim.join(earlier, "uid", "left_semi").isEmpty():
                raise MatchError(f"id column {self.id_col} must be unique over all batches")
        found, found_folder = write_table(slim.groupBy("digest", *self.keys).agg(F.min("uid").alias("pid"), F.count(F.lit(1)).alias("n")), "kept-batch")
        if not self.tables:
            fresh, links = found, write_table(self._links(found), "kept-links")
            self._keep(profiles=found, components=connected_components(links[0]), best=best_match_probability(links[0]))
        else:
            kept = self.tables["profiles"][0]
            fresh = found.join(kept.select("digest"), "digest", "left_anti").select(*found.columns)
            links = write_table(self._links(fresh), "kept-links")
            again = found.select("digest", F.col("n").alias("more"))
            more = kept.join(again, "digest", "left").withColumn("n", F.col("n") + F.coalesce("more", F.lit(0))).select(*kept.columns)
            best = self.tables["best"][0].unionByName(best_match_probability(links[0]))
            self._keep(
                profiles=more.unionByName(fresh.select(*kept.columns)),
                components=extend_components(self.tables["components"][0], links[0]),
                best=best.groupBy("uid").agg(F.max("best").alias("best")),
            )
        self.members.append(write_table(slim.select("uid", "digest"), "kept-members")[0])
        release(batch.sparkSession, [found_folder, links[1]])
        return self

    def entities(self) -> DataFrame:
        """``(id_col, entity, match_probability)`` of all records so far; an entity is named by its smallest id."""
        if not self.tables:
            raise MatchError("no records were added")
        profiles, comps, best = (self.tables[name][0] for name in ("profiles", "components", "best"))
        states = profile_states(profiles, comps, best, self.own, self.threshold, self.within, ["digest"])
        members = self.members[0]
        for more in self.members[1:]:
            members = members.unionByName(more)
        labels = members.join(states, "digest").select(
            "uid", F.when(F.col("shared"), F.col("proot")).otherwise(F.col("uid")).alias("root"), F.coalesce("pbest", F.lit(1.0)).alias(PROB_COL)
        )
        first = labels.groupBy("root").agg(F.min("uid").alias(ENTITY))
        return labels.join(first, "root").select(F.col("uid").alias(self.id_col), ENTITY, PROB_COL)
