"""The plan from pages to documents, and the registry of pipelines."""

import time
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RuleConfig
from ..operators import content, document, lines, quarantine, rewrite, sections, validate, warnings
from ..schemas import DOCUMENT
from ..scratch import Scratch


STEPS = ("lines", "drafts", "content", "plates", "sections", "broken")


@dataclass(frozen=True)
class SymbolicPlan:
    """Lazy DataFrames of every step over ``pages(doc_id, page_no, text)``; nothing runs before an action.

    ``keep`` names the steps that are read more than once; of a step that is not kept, Spark makes only the columns that are asked for.
    """

    pages: DataFrame
    cfg: RuleConfig = RuleConfig()
    files: DataFrame | None = None
    found_errors: DataFrame | None = None
    keep: tuple[str, ...] = STEPS

    @classmethod
    def guarded(cls, raw: DataFrame, cfg: RuleConfig = RuleConfig(), files: DataFrame | None = None) -> "SymbolicPlan":
        """A plan over the sound documents of ``raw`` with the sound rules of ``cfg``; what is set aside is in ``errors``."""
        cfg, rules = quarantine.sound_rules(raw.sparkSession, cfg)
        parted = quarantine.part_pages(raw)
        return cls(parted.pages, cfg, files, rules.unionByName(parted.errors))

    def _kept(self, df: DataFrame, step: str) -> DataFrame:
        """Where several steps read this one, Spark keeps it (or recomputes what an executor lost)."""
        return df.persist() if step in self.keep else df

    @cached_property
    def lines(self) -> DataFrame:
        return self._kept(lines.split_lines(self.pages, self.cfg), "lines")

    @cached_property
    def discarded(self) -> DataFrame:
        return lines.discarded(self.lines)

    @cached_property
    def drafts(self) -> DataFrame:
        return self._kept(sections.section_drafts(self.lines), "drafts")

    @cached_property
    def content(self) -> DataFrame:
        return self._kept(content.with_content(self.drafts, self.cfg), "content")

    @cached_property
    def merged(self) -> DataFrame:
        return rewrite.merge_tables(self.content)

    @cached_property
    def plates(self) -> DataFrame:
        return self._kept(rewrite.split_rating_plates(self.merged, self.cfg), "plates")

    @cached_property
    def implicit(self) -> DataFrame:
        return rewrite.split_implicit(self.plates, self.cfg)

    @cached_property
    def sections(self) -> DataFrame:
        return self._kept(warnings.annotate(self.implicit, self.cfg), "sections")

    def _counted(self, warned: bool = False) -> DataFrame:
        """It counts texts, tables, figures and, if asked, warnings; numbered ids change none of them."""
        if "sections" in self.__dict__:
            found = self.sections
        else:
            found = rewrite.implicit_children(self.plates, self.cfg)
            found = warnings.annotate(found, self.cfg) if warned else found
        return document.counted(self.pages, self.lines, found, self.cfg)

    @cached_property
    def quality(self) -> DataFrame:
        return self._counted().select(*document.QUALITY)

    @cached_property
    def headers(self) -> DataFrame:
        """Documents with the numbers of their sections and discarded blocks in place of these; no document becomes a row that grows with it."""
        return document.headers(self._counted(), self.cfg, self.files)

    @cached_property
    def violations(self) -> DataFrame:
        """``doc_id, path, rule`` for every place where a document's JSON differs from its schema, checked element by element."""
        sections, text = self.sections, lambda *cols: F.to_json(F.struct(*cols))
        frame = document.headed(self.quality, self.cfg, self.files)
        none = [F.array().cast("array<string>").alias(c) for c in ("sections", "discarded_blocks")]
        out = validate.violations(frame.select("doc_id", text(*[c for c in frame.columns if c != "doc_id"], *none).alias("json")), DOCUMENT)
        for array, rows, order, x in (("sections", document.section_rows(sections, self.cfg), rewrite.ORDER, "s"), ("discarded_blocks", document.block_rows(self.lines), ("line_no",), "b")):
            out = out.unionByName(validate.element_violations(rows.filter("doc_id is not null").select("doc_id", *order, F.to_json(x).alias("json")), DOCUMENT, array, order))
        return out

    @cached_property
    def json_parts(self) -> DataFrame:
        """The documents' JSON texts in parts, none of them a whole document."""
        sections = self.sections
        return document.json_parts(self.quality, self.lines, sections, self.cfg, self.files)

    @cached_property
    def documents(self) -> DataFrame:
        sections = self.sections  # the quality counts these once they are there
        return document.nested(self.quality, self.lines, sections, self.cfg, self.files)

    @cached_property
    def broken(self) -> DataFrame:
        """Documents of which a step broke its promises: ``doc_id, step, error``."""
        out = quarantine.broken_promises("lines", self.lines)
        for step in ("drafts", "content", "sections"):
            out = out.unionByName(quarantine.broken_promises(step, getattr(self, step)))
        return self._kept(out, "broken")

    @cached_property
    def errors(self) -> DataFrame:
        """Everything that was set aside, by document and step; rules have no document."""
        return self.broken if self.found_errors is None else self.found_errors.unionByName(self.broken)

    @cached_property
    def accepted(self) -> DataFrame:
        """Documents without an error."""
        return self.documents.join(self.broken.select(F.col("doc_id").alias("bad_")), F.col("doc_id").cast("string") == F.col("bad_"), "left_anti")

    @cached_property
    def summary(self) -> DataFrame:
        return document.counters(self._counted(warned=True), self.files)

    def release(self) -> None:
        """Give back what the steps made so far have kept."""
        for name in STEPS:
            if name in self.__dict__:
                self.__dict__[name].unpersist()

    def views(self) -> None:
        """Register the flat steps for Spark SQL."""
        for name in ("lines", "discarded", "sections", "quality", "documents"):
            getattr(self, name).createOrReplaceTempView(f"{self.cfg.name}_{name}")


class RecordedPlan(SymbolicPlan):
    """A plan whose steps are written tables of the shared folder, each with its rows, characters and seconds on record."""

    @cached_property
    def _scratch(self) -> Scratch:
        return Scratch(self.pages.sparkSession, f"run-{self.cfg.name}")

    @cached_property
    def _records(self) -> list[tuple[str, str, int, int, float]]:
        return []

    def _kept(self, df: DataFrame, step: str) -> DataFrame:
        if step not in self.keep:
            return df
        began = time.monotonic()
        chars = F.sum(F.length("text")) if "text" in df.columns else F.sum(F.lit(0))
        out, told = self._scratch.save_and_tell(df, step, F.coalesce(chars, F.lit(0)).cast("long").alias("chars"))
        self._records.append((self.cfg.name, step, told["n"], told["chars"], time.monotonic() - began))
        return out

    @property
    def statistics(self) -> DataFrame:
        """``pipeline, step, n_rows, n_chars, seconds`` of the steps that have run so far; run all by reading ``sections`` or what follows it."""
        return self.pages.sparkSession.createDataFrame(self._records, "pipeline string, step string, n_rows long, n_chars long, seconds double")

    def release(self) -> None:
        for _, step, *_ in self._records:
            self._scratch.drop(step)


@dataclass(frozen=True)
class Verticals:
    """Several rule sets over one corpus: ``pages(doc_id, page_no, text, vertical)``, each document under the rules of its vertical.

    The pages are read, shuffled and split once; every line's rules are chosen by its vertical.  What follows reads the kept lines.
    Documents of a vertical without rules are left out.
    """

    pages: DataFrame
    rules: dict[str, RuleConfig]

    @cached_property
    def lines(self) -> DataFrame:
        return lines.split_lines_by(self.pages, self.rules).persist()

    def single(self, vertical: str) -> SymbolicPlan:
        """The plan of one vertical, on the lines of all."""
        plan = SymbolicPlan(self.pages.filter(F.col("vertical") == vertical).drop("vertical"), self.rules[vertical])
        plan.__dict__["lines"] = self.lines.filter(F.col("vertical") == vertical).drop("vertical")
        return plan

    @cached_property
    def plans(self) -> dict[str, SymbolicPlan]:
        return {v: self.single(v) for v in self.rules}

    def all(self, step: str) -> DataFrame:
        """A step's table of every vertical, with the column ``vertical``."""
        parts = [getattr(p, step).withColumn("vertical", F.lit(v)) for v, p in self.plans.items()]
        return reduce(DataFrame.unionByName, parts)

    def release(self) -> None:
        for p in self.plans.values():
            p.release()
        self.lines.unpersist()


REGISTRY = {"product_technical": {"symbolic": SymbolicPlan}}
