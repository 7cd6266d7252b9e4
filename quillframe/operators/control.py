"""The control plane: artifact graph, drift, decisions, ledger, rule composition. Its tables are small and driver-side where they steer."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("ok", "failed", "blocked", "HOLD_INPUT_DRIFT", "awaiting-human", "satisfied", "external-runner", "no-runner", "dry-run")


class BadGraph(ValueError):
    pass


def canonical(value: object) -> str:
    """JSON with sorted keys and no spaces: what configuration is hashed by."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def order(steps: dict[str, tuple[Iterable[str], Iterable[str]]], external: Iterable[str] = ()) -> list[str]:
    """Steps (name to consumed and produced artifacts) in an order in which inputs exist; what is left is a cycle or lacks an input."""
    there, left, out = set(external), dict(steps), []
    while left:
        ready = sorted(s for s, (needs, _) in left.items() if set(needs) <= there)
        if not ready:
            raise BadGraph(f"cycle or missing input: {sorted(left)}")
        for s in ready:
            there |= set(left.pop(s)[1])
            out.append(s)
    return out


def dangling(edges: DataFrame, external: DataFrame) -> DataFrame:
    """Consumed (artifact, generation) that no step makes and that is not external. edges: step, artifact, generation, direction."""
    keys = ["artifact", "generation"]
    made = edges.where("direction = 'out'").select(*keys).unionByName(external.select(*keys))
    return edges.where("direction = 'in'").join(made, keys, "left_anti")


def chain_health(declared: DataFrame, present: DataFrame, prior: DataFrame) -> DataFrame:
    """present, missing, drifted or unbound for each declared artifact, with its producer."""
    rows = declared.join(present.select("artifact", F.col("digest").alias("now")), "artifact", "left").join(prior.select("artifact", F.col("digest").alias("then")), "artifact", "left")
    status = F.when(F.col("external") & F.col("path").isNull(), "unbound").when(F.col("now").isNull(), F.when(F.col("external"), "absent").otherwise("missing")).when(F.col("then").isNotNull() & (F.col("then") != F.col("now")), "drifted").otherwise("present")
    return rows.withColumn("status", status).drop("now", "then")


def unknown(named: DataFrame, declared: DataFrame, external: DataFrame, bound: DataFrame) -> DataFrame:
    """Artifacts (step, artifact) that nobody declares, and external ones without a binding: artifact, step, problem."""
    lost = named.join(declared.select("artifact"), "artifact", "left_anti").select("artifact", "step", F.lit("UNKNOWN_ID").alias("problem"))
    loose = external.select("artifact").join(bound.select("artifact"), "artifact", "left_anti").select("artifact", F.lit(None).cast("string").alias("step"), F.lit("UNBOUND_EXTERNAL").alias("problem"))
    return lost.unionByName(loose)


def step_status(steps: DataFrame, inputs: DataFrame, outputs: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """What becomes of each step of a chain, first that holds, one of STATUSES.

    blocked while an input that is not optional is missing; HOLD_INPUT_DRIFT while an input that is followed by its
    digest differs from the one last run with; a person's step awaits its products or is satisfied; without a command
    it is an external runner's, or nobody's; a dry run stops here; then failed or ok by its return code.

    steps: step and, where there are such, runner, command, external_entry, return_code, code_then, code_now.
    inputs: step, artifact, ran_with, now and perhaps optional. outputs: step, artifact, there. With code digests,
    code_drift tells that products made by other code are there; that is reported, it does not hold.
    """
    names = steps.columns
    have = lambda c, kind: F.col(c) if c in names else F.lit(None).cast(kind)
    optional = F.coalesce("optional", F.lit(False)) if "optional" in inputs.columns else F.lit(False)
    drift = inputs.groupBy("step").agg(F.max((F.col("ran_with") != F.col("now")).cast("int")).alias("__drifted"), F.max((F.col("now").isNull() & ~optional).cast("int")).alias("__lacking"))
    rows = steps.join(drift, "step", "left")
    if outputs is None:
        rows = rows.withColumns({"__absent": F.lit(1), "__made": F.lit(0)})
    else:
        there = outputs.groupBy("step").agg(F.max((~F.col("there")).cast("int")).alias("__absent"), F.max(F.col("there").cast("int")).alias("__made"))
        rows = rows.join(there, "step", "left")
    command = have("command" if "command" in names else "runner", "string")
    status = F.when(F.col("__lacking") == 1, "blocked").when(F.col("__drifted") == 1, "HOLD_INPUT_DRIFT")
    status = status.when(have("runner", "string") == "human", F.when(F.coalesce("__absent", F.lit(1)) == 1, "awaiting-human").otherwise("satisfied"))
    status = status.when(command.isNull(), F.when(have("external_entry", "string").isNotNull(), "external-runner").otherwise("no-runner"))
    if dry_run:
        status = status.otherwise("dry-run")
    else:
        status = status.when(F.coalesce(have("return_code", "int"), F.lit(0)) != 0, "failed").otherwise("ok")
    drifted = F.coalesce((have("code_then", "string") != have("code_now", "string")) & (F.col("__made") == 1), F.lit(False))
    return rows.withColumns({"status": status, "code_drift": drifted}).drop("__drifted", "__lacking", "__absent", "__made")


def decisions(log: DataFrame) -> DataFrame:
    """The latest state of each item of an append-only queue (item, at, event, choice, reason, options).

    Opening never undoes a decision; a decision counts only for one of the item's options and with a reason.
    """
    opened = log.where("event = 'open'").groupBy("item").agg(F.min_by("options", "at").alias("options"))
    made = log.where("event = 'decide'").select("item", "at", "choice", "reason")
    valid = made.join(opened, "item").where(F.array_contains("options", F.col("choice")) & (F.trim(F.coalesce("reason", F.lit(""))) != ""))
    last = valid.groupBy("item").agg(F.max_by(F.struct("choice", "reason"), "at").alias("d"))
    return opened.join(last, "item", "left").select("item", "options", F.when(F.col("d").isNull(), "pending").otherwise("decided").alias("state"), "d.choice", "d.reason")


def archive(parts: dict[str, bytes]) -> bytes:
    """A zip file of the parts whose bytes depend on nothing else: names sorted, one date for all, no attributes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as file:
        for name in sorted(parts):
            entry = zipfile.ZipInfo(name, date_time=(1980, 1, 1, 0, 0, 0))
            entry.compress_type, entry.create_system, entry.external_attr = zipfile.ZIP_DEFLATED, 0, 0
            file.writestr(entry, parts[name])
    return out.getvalue()


def archives(parts: DataFrame, *keys: str) -> DataFrame:
    """One archive by key of its parts (name, content): archive and its sha256. A key's parts are the files of one document."""

    @F.pandas_udf("binary")
    def packed(rows: pd.Series) -> pd.Series:
        return rows.map(lambda some: archive({p["name"]: bytes(p["content"]) for p in some}))

    grouped = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("name", "content"))).alias("parts"))
    return grouped.select(*keys, packed("parts").alias("archive")).withColumn("digest", F.sha2("archive", 256))


def latest_run(ledger: DataFrame) -> DataFrame:
    """The last run of each source, volume and schema of an append-only ledger."""
    nth = F.row_number().over(Window.partitionBy("source_id", "volume_key", "schema_hash").orderBy(F.desc("started_at"), F.desc("run_id")))
    return ledger.withColumn("nth", nth).where("nth = 1").drop("nth")


def harvest(debriefs: DataFrame) -> DataFrame:
    """Candidate rules of filled debriefs, and whether each is pending."""
    rows = debriefs.where("filled").select("run", F.explode("candidate_rules").alias("c")).select("run", "c.*")
    return rows.withColumn("pending", F.coalesce(F.col("status"), F.lit("pending")) == "pending")


def compose(base: dict, deviation: dict, required: Iterable[str] = ()) -> dict:
    """Defaults with deviations on top; a required key that neither gives is refused."""
    out = {**base, **deviation}
    lacking = sorted(k for k in required if out.get(k) is None)
    if lacking:
        raise BadGraph(f"required and missing: {lacking}")
    return out


def split(whole: dict, base: dict) -> dict:
    """The deviation that :func:`compose` makes ``whole`` of again."""
    return {k: v for k, v in whole.items() if k not in base or base[k] != v}


def merge_mapping(own: dict, shared: dict, whole: Iterable[str], keys: Iterable[str]) -> dict:
    """Whole shared sections and chosen keys, the own ones on top."""
    out = {s: shared[s] for s in whole if s in shared}
    for k in keys:
        if k in shared.get("run", {}):
            out.setdefault("run", {})[k] = shared["run"][k]
    for section, value in own.items():
        out[section] = {**out.get(section, {}), **value} if isinstance(value, dict) else value
    return out


def styles(roots: dict[str, dict], packs: dict[str, dict], base: dict) -> list[dict]:
    """Every root with every pack over the base, with the three hashes."""
    return [{"root": r, "pack": p, "values": {**base, **root, **pack}, "root_sha256": digest(root), "pack_sha256": digest(pack), "combined_sha256": digest({**base, **root, **pack})} for r, root in sorted(roots.items()) for p, pack in sorted(packs.items())]


def project(keys: DataFrame, style: DataFrame, root: DataFrame, defaults: DataFrame) -> DataFrame:
    """Each governed key's value and where it is from; a default or nothing is a gap, not a result."""
    named = lambda rows, name: rows.select("key", F.col("value").alias(name))
    rows = keys.join(named(style, "s"), "key", "left").join(named(root, "r"), "key", "left").join(named(defaults, "d"), "key", "left")
    origin = F.when(F.col("s").isNotNull(), "style").when(F.col("r").isNotNull(), "root").when(F.col("d").isNotNull(), "default").otherwise("none")
    return rows.select("key", F.coalesce("s", "r", "d").alias("value"), origin.alias("origin"), origin.isin("default", "none").alias("gap"))


def flatten(prefix: str, value: object) -> list[tuple[str, str, object]]:
    """(path, key, leaf) of nested configuration."""
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in flatten(f"{prefix}/{k}", v)]
    if isinstance(value, list):
        return [x for k, v in enumerate(value) for x in flatten(f"{prefix}[{k}]", v)]
    return [(prefix, prefix.rpartition("/")[2].partition("[")[0], value)]
