"""Identity values: cleaning, endpoints, model and protocol identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from proofmill.functions.canonical import canonical_variant, digest, json_object, json_strings, json_text, keep_numbers, let, restore_numbers
from proofmill.functions.redaction import redact_text

# Settings that do not belong to the evaluation protocol.
PROTOCOL_EXCLUDED_KEYS = [
    "model", "model_id", "api_url", "api_key", "work_dir", "no_timestamp", "use_cache",
    "collect_perf", "ignore_errors", "limit", "eval_batch_size", "output_dir", "dataset_dir",
]

# Digest of the empty category path: marks a metric's top-level row.
TOP_CATEGORY_KEY = "4f53cda18c2baa0c0354bb5f9a3ecbe5ed12ab4d8e11ba873c2f11161202b945"


def clean_identity(value: Column) -> Column:
    """Missing, empty and blank all mean unknown (NULL); other values stay as they are."""
    return F.when(~value.rlike(r"^(?U)[\s\x1c-\x1f]*$"), value)


def short_hash(value: Column, length: int = 10) -> Column:
    return F.substring(F.coalesce(value, F.lit("")), 1, length)


def _split_endpoint(url: Column) -> Column:
    scheme = F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))
    rest = F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*:", ""), r"[?#].*$", "")
    return F.named_struct(F.lit("scheme"), scheme, F.lit("rest"), rest)


def _place(parts: Column) -> Column:
    authority = F.regexp_extract(parts["rest"], r"^//([^/]*)", 1)
    host_port = F.regexp_replace(authority, r"^.*@", "")
    return F.named_struct(
        F.lit("head"), F.concat(F.when(parts["scheme"] == "", F.lit("https")).otherwise(parts["scheme"]), F.lit(":")),
        F.lit("host"), F.lower(F.regexp_replace(host_port, r":[0-9]*$", "")),
        F.lit("port"), F.ltrim(F.regexp_extract(host_port, r":([0-9]*)$", 1), F.lit("0")),
        F.lit("path"), F.regexp_replace(parts["rest"], r"^//[^/]*", ""),
    )


def _join_endpoint(p: Column) -> Column:
    netloc = F.concat(p["host"], F.when(p["port"] != "", F.concat(F.lit(":"), p["port"])).otherwise(F.lit("")))
    rooted = (p["path"] == "") | p["path"].startswith("/")
    joined = F.when(
        (p["host"] != "") | (p["port"] != ""),
        F.concat(p["head"], F.lit("//"), netloc, F.when(rooted, F.lit("")).otherwise(F.lit("/")), p["path"]),
    ).otherwise(F.concat(p["head"], F.when(rooted, F.lit("//")).otherwise(F.lit("")), p["path"]))
    return F.regexp_replace(joined, r"/+$", "")


def endpoint_identity(api_url: Column) -> Column:
    """scheme://host[:port]/path without credentials, query, fragment or end slash."""
    url = redact_text(F.coalesce(api_url, F.lit("")))
    return let(let(let(url, _split_endpoint), _place), _join_endpoint)


def model_config_identity(alias: Column, model_id: Column, api_url: Column, deployment_version: Column) -> Column:
    return digest(
        json_object(
            alias=json_text(alias),
            model_id=json_text(F.coalesce(model_id, F.lit(""))),
            endpoint=let(endpoint_identity(api_url), json_text),
            deployment_version=json_text(F.coalesce(deployment_version, F.lit("unknown"))),
        )
    )


def protocol_identity(config_json: Column) -> Column:
    """Digest of a resolved configuration without model, storage and sampling settings; numbers count as they are written."""
    top = F.try_variant_get(F.try_parse_json(keep_numbers(config_json)), "$", "map<string,variant>")
    kept = F.map_filter(top, lambda key, _: ~key.isin(PROTOCOL_EXCLUDED_KEYS))

    def without_local_path(args: Column) -> Column:
        members = F.try_variant_get(args, "$", "map<string,variant>")
        fields = F.filter(F.map_entries(members), lambda e: e["key"] != "local_path")
        body = F.transform(fields, lambda e: F.concat(json_text(e["key"]), F.lit(":"), canonical_variant(e["value"])))
        return F.coalesce(F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}")), F.lit("{}"))

    def member(entry: Column) -> Column:
        datasets = F.try_variant_get(entry["value"], "$", "map<string,variant>")
        stripped = F.concat(
            F.lit("{"),
            F.array_join(
                F.transform(F.map_entries(datasets), lambda e: F.concat(json_text(e["key"]), F.lit(":"), without_local_path(e["value"]))),
                ",",
            ),
            F.lit("}"),
        )
        value = F.when(
            (entry["key"] == "dataset_args") & datasets.isNotNull(), stripped
        ).otherwise(canonical_variant(entry["value"]))
        return F.concat(json_text(entry["key"]), F.lit(":"), value)

    body = F.transform(F.map_entries(kept), member)
    return digest(restore_numbers(F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}"))))


def metric_key(name: Column, aggregation: Column, dimensions_json: Column) -> Column:
    """Identity of a metric: name, aggregation and dimensions (canonical JSON object)."""
    return digest(
        json_object(
            name=json_text(name),
            aggregation=json_text(aggregation),
            dimensions=F.coalesce(dimensions_json, F.lit("{}")),
        )
    )


def category_key(path: Column) -> Column:
    return digest(json_strings(path))
