"""Scalar functions as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Secrets as they appear in logs, and what is kept of them.
SECRETS = (
    (r"(?i)(sessionid(?:_ss)?=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(sid_guard=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(sid_tt=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(msToken=)[a-zA-Z0-9%_\./+-]+", "$1[REDACTED]"),
    (r"(?i)(a_bogus=)[a-zA-Z0-9%_\./+-]+", "$1[REDACTED]"),
    (r"(?i)(passport_csrf_token(?:_default)?=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(Bearer\s+)[a-zA-Z0-9%_\.\-]+", "$1[REDACTED]"),
    (r"(?i)((?:bearer|token|access_token)=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(--cookie\s+[\"']?)[^\"'\s]+([\"']?)", "$1[REDACTED]$2"),
    (r"(?i)(['\"]--cookie['\"],\s*['\"])[^'\"]+(['\"])", "$1[REDACTED]$2"),
)
# Secrets as logs of the collector have them.
REDACTIONS = (
    (r"(?i)(sessionid(?:_ss)?=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(sid_guard=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(sid_tt=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(msToken=)[a-zA-Z0-9%_\./+=-]+", "$1[REDACTED]"),
    (r"(?i)(a_bogus=)[a-zA-Z0-9%_\./+=-]+", "$1[REDACTED]"),
    (r"(?i)(passport_csrf_token(?:_default)?=)[a-zA-Z0-9%_-]+", "$1[REDACTED]"),
    (r"(?i)(Bearer\s+)[a-zA-Z0-9_\-\.]+", "$1[REDACTED]"),
)
# Names that a file may not have, extensions of unfinished files.
RESERVED = ("CON", "PRN", "AUX", "NUL", *(f"{d}{n}" for d in ("COM", "LPT") for n in range(1, 10)))
UNFINISHED = (".part", ".tmp", ".crdownload", ".download", ".incomplete")


def normalised_statement(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def estimated_tokens(text: Column) -> Column:
    """Han characters and punctuation count one each, runs of ASCII word characters a quarter of their length, rounded up; 1 at least."""
    han = F.regexp_count(text, F.lit(r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}]"))
    runs = F.aggregate(F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9_./:+#-]+)"), F.lit(1)), F.lit(0), lambda a, r: a + F.floor((F.length(r) + 3) / 4).cast("int"))
    marks = F.regexp_count(text, F.lit(r"(?U)[^\s\w\x{3400}-\x{9fff}\x{f900}-\x{faff}]"))
    return F.greatest(F.lit(1), han + runs + marks)


def clock(seconds: Column) -> Column:
    """HH:MM:SS, rounded half to even, never negative."""
    s = F.greatest(F.lit(0), F.bround(seconds, 0)).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def published_at(epoch: Column) -> Column:
    """ISO text of seconds or, above 1e11, milliseconds; fractions only if there are any."""
    millis = F.when(epoch > 1e11, epoch).otherwise(epoch * 1000).cast("bigint")
    zero = F.lit(0)
    since = F.make_dt_interval(zero, zero, zero, F.floor(millis / 1000).cast("decimal(18,6)"))
    whole = F.date_format(F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), zero, zero, zero) + since, "yyyy-MM-dd'T'HH:mm:ss")  # whatever the session's time zone
    part = F.when(F.pmod(millis, F.lit(1000)) > 0, F.format_string(".%03d000", F.pmod(millis, F.lit(1000)))).otherwise("")
    return F.concat(whole, part, F.lit("+00:00"))


def hashtags(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"#([^\s#]+)"), F.lit(1)))


def without_secrets(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for pattern, kept in SECRETS:
        out = F.regexp_replace(out, pattern, kept)
    return out


def redacted(text: Column) -> Column:
    """The text without what logs may not show; null stays null."""
    for pattern, kept in REDACTIONS:
        text = F.regexp_replace(text, pattern, kept)
    return text


def safe_name(name: Column, longest: int = 255) -> Column:
    """A file name that any system takes."""
    clean = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', "_"), r"^[. ]+|[. ]+$", "")
    clean = F.when(F.coalesce(clean, F.lit("")) == "", "unnamed").otherwise(clean)
    clean = F.when(F.upper(F.split_part(clean, F.lit("."), F.lit(1))).isin(list(RESERVED)), F.concat(F.lit("_"), clean)).otherwise(clean)
    return F.when(F.length(clean) > longest, F.regexp_replace(F.substring(clean, 1, longest), r"[. ]+$", "")).otherwise(clean)


def safe_extension(extension: Column) -> Column:
    """With its dot, lower case, at most ten letters or digits; null where unfinished or without any."""
    e = F.lower(F.trim(extension))
    e = F.when(F.startswith(e, F.lit(".")), e).otherwise(F.concat(F.lit("."), e))
    body = F.substring(F.regexp_replace(F.substring(e, 2, 1000), "[^a-z0-9]", ""), 1, 10)
    bad = e.isin(list(UNFINISHED)) | e.contains("/") | e.contains("\\") | e.contains("..") | (body == "")
    return F.when(F.coalesce(extension, F.lit("")) == "", "").when(bad, None).otherwise(F.concat(F.lit("."), body))


def extension_changed(extension: Column) -> Column:
    """Whether an extension had to be cleaned: it isn't letters and digits alone, or is longer than ten."""
    body = F.regexp_replace(F.lower(F.trim(extension)), r"^\.", "")
    return F.coalesce(safe_extension(extension).isNotNull() & (F.coalesce(extension, F.lit("")) != "") & ~body.rlike("^[a-z0-9]{1,10}$"), F.lit(False))


def artifact_name(content_id: Column, role: Column, sequence: Column, extension: Column) -> Column:
    stem = safe_name(content_id)
    return (
        F.when(role == "album_image", F.concat(stem, F.format_string("_img_%03d", sequence), extension))
        .when(role == "bgm_audio", F.concat(stem, F.lit("_bgm"), extension))
        .when(role == "cover_image", F.concat(stem, F.lit("_cover"), extension))
        .otherwise(F.concat(stem, extension))
    )


def unit_id(canonical_id: Column, unit_type: Column, evidence: Column, statement: Column) -> Column:
    """Content address of a knowledge unit; the order of its evidence counts."""
    whole = F.concat_ws("|", F.lit("knowledge-units-v1"), canonical_id, unit_type, F.array_join(evidence, ","), normalised_statement(statement))
    return F.concat(F.lit("ku_"), F.substring(F.sha2(whole, 256), 1, 16))


def task_id(platform: Column, scope: Column, content_id: Column, content_type: Column) -> Column:
    digest = F.substring(F.sha2(F.concat_ws("|", platform, scope, content_id, content_type, F.lit("v1")), 256), 1, 16)
    return F.concat(F.lit("dl_"), platform, F.lit("_"), content_id, F.lit("_"), digest)


def watermark_reached(cursor: Column, committed: Column) -> Column:
    """Whole numbers by size, anything else by equality."""
    return F.coalesce(F.expr("true") & (cursor.try_cast("decimal(38,0)") <= committed.try_cast("decimal(38,0)")), cursor == committed)


def backoff(attempt: Column, base: float = 2.0, factor: float = 2.0, most: float = 60.0) -> Column:
    return F.round(F.least(F.lit(most), F.lit(base) * F.pow(F.lit(factor), attempt - 1)), 3)


def retry_after(text: Column, now: Column | None = None) -> Column:
    """Seconds between 1 and 300, from a number or an HTTP date after ``now`` (a timestamp; the clock's by default); else 60."""
    number = F.trim(text).try_cast("double")
    date = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3}, ", ""), " GMT$", " +0000"), F.lit("dd MMM yyyy HH:mm:ss xx"))
    ahead = F.when(number.isNull() & text.contains(":"), (F.unix_timestamp(date) - F.unix_timestamp(now if now is not None else F.current_timestamp())).cast("double"))

    def bounded(seconds: Column) -> Column:
        sound = (seconds > 0) & (seconds < float("inf")) & ~F.isnan(seconds)
        return F.when(sound, F.least(F.lit(300.0), F.greatest(F.lit(1.0), seconds))).otherwise(60.0)

    return F.get(F.transform(F.array(F.coalesce(number, ahead)), bounded), F.lit(0))  # one evaluation of the text


def escaped_excerpt(text: Column) -> Column:
    """Markdown block quote of an excerpt."""
    return F.array_join(F.transform(F.split(F.regexp_replace(text, r"([\\`*_{}\[\]<>#|])", r"\\$1"), "\n"), lambda line: F.concat(F.lit("> "), line)), "\n")
