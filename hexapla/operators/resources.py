"""Resources of catalogue records: version maps, availability and its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexapla.functions.text import extension, url_extension, url_name
from hexapla.operators.merge import last_wins


def versions(items: DataFrame) -> DataFrame:
    """From (no, pos, category, url): (no, category, url, filename, ext, reason), the last item of each category; blank URLs
    stay, as null with a reason."""
    last, _ = last_wins(items.filter("category is not null and category <> '' and not startswith(category, '_')"), ["no", "category"], "pos")
    url = F.nullif(F.trim("url"), F.lit(""))
    ext = extension(F.coalesce(url_extension(url), F.lit("")), "mp3")
    return last.select("no", "category", url.alias("url"), F.when(url.isNotNull(), url_name(url)).alias("filename"), ext.alias("ext"), F.when(url.isNull(), F.lit("no_url")).alias("reason"))


def version_map(found: DataFrame) -> DataFrame:
    """(no, versions): a map from category to the rest."""
    entry = F.struct(F.col("category"), F.struct("url", "filename", "ext", "reason"))
    return found.groupBy("no").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("versions"))


def available(url: Column) -> Column:
    """Whether there is a URL."""
    return F.coalesce(url != "", F.lit(False))


def reason(url: Column, error: Column, removed: Column) -> Column:
    """Why a resource is unavailable: removed from the site, null if it is available, else the recorded reason or network."""
    return F.when(F.coalesce(removed, F.lit(False)), "site_removed").when(available(url), None).otherwise(F.coalesce(F.nullif(error, F.lit("")), F.lit("network")))


def expected_resources(manifest: DataFrame) -> DataFrame:
    """From (no, staff_pdf, numbered_pdf, versions): (no, kind, tag, url), the one view that downloads, checks and
    scorecards share."""
    pdfs = manifest.select("no", F.expr("stack(2, 'pdf', 'staff', staff_pdf, 'pdf', 'numbered', numbered_pdf) as (kind, tag, url)"))
    audio = manifest.select("no", F.explode("versions").alias("tag", "v")).select("no", F.lit("audio").alias("kind"), "tag", F.col("v.url").alias("url"))
    return pdfs.unionByName(audio.filter("tag <> '' and not startswith(tag, '_')"))


def carry_removed(fresh: DataFrame, previous: DataFrame, files: DataFrame) -> DataFrame:
    """Versions (no, category) that the fresh set lacks but of which a local file exists, kept as site_removed."""
    gone = previous.join(fresh.select("no", "category"), ["no", "category"], "left_anti").join(files.select("no", "category"), ["no", "category"], "left_semi")
    return fresh.withColumn("site_removed", F.lit(False)).unionByName(gone.withColumn("site_removed", F.lit(True)), allowMissingColumns=True)


def to_download(offered: DataFrame, owned: DataFrame, unavailable: DataFrame) -> DataFrame:
    """Offered versions (no, category) that are neither owned nor known to be unavailable; one that was never probed counts
    as downloadable."""
    keys = ["no", "category"]
    return offered.join(owned.select(*keys), keys, "left_anti").join(unavailable.select(*keys), keys, "left_anti")


def with_checks(resources: DataFrame, checks: DataFrame) -> DataFrame:
    """``resources`` (no, kind, tag, ...) with the result of their check: ok, http_status, error, all null if unchecked."""
    return resources.join(checks.select("no", "kind", "tag", "ok", "http_status", "error"), ["no", "kind", "tag"], "left")


def unavailable_summary(checked: DataFrame) -> DataFrame:
    """(no, unavailable, reasons): how many resources of a record are unavailable, without those removed from the site, and
    the reasons, sorted."""
    bad = checked.filter("reason is not null")
    return bad.groupBy("no").agg(F.count_if(F.col("reason") != "site_removed").alias("unavailable"), F.array_sort(F.collect_set("reason")).alias("reasons"))
