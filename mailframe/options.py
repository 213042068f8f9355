"""Frozen importer options (P21, F2, K10) with the reference's defaults."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException

# Defaults of the reference's settings.
DEFAULT_INDEX_NAME = "imapriverdata"
DEFAULT_TYPE_NAME = "mail"
DEFAULT_STRATEGY = "all_in_one"
DEFAULT_INTERVAL = "60 seconds"
DEFAULT_PROTOCOL = "imaps"


def _bool(v) -> bool:
    if isinstance(v, str):
        return v.strip().lower() == "true"
    return bool(v)


class InvalidPattern(ValueError):
    pass


def validate_pattern(pattern: str | None) -> None:
    """an invalid folder pattern fails at option parse time (never runs unfiltered).

    The JVM runs the pattern, so the JVM judges it.  Options made before there is a
    session are judged when the pattern is first used, which checks again.
    """
    context = SparkContext._active_spark_context
    if pattern is None or context is None:
        return
    try:
        context._jvm.java.util.regex.Pattern.compile(pattern)
    except (Py4JJavaError, IllegalArgumentException) as e:
        raise InvalidPattern(f"invalid folder pattern {pattern!r}: {e}") from e


@dataclass(frozen=True)
class MailOptions:
    with_text_content: bool = True
    with_html_content: bool = False
    prefer_html_content: bool = False
    with_attachments: bool = False
    with_striptags_from_textcontent: bool = True
    headers_to_fields: tuple[str, ...] = ()
    with_flag_sync: bool = True
    keep_expunged_messages: bool = False
    folderpattern: str | None = None
    mail_index_name: str = DEFAULT_INDEX_NAME
    mail_type_name: str = DEFAULT_TYPE_NAME
    mail_index_name_strategy: str = DEFAULT_STRATEGY
    interval: str = DEFAULT_INTERVAL
    extra: dict = field(default_factory=dict, compare=False)

    @staticmethod
    def from_settings(settings: dict) -> "MailOptions":
        """Numbers and booleans may arrive as strings ("true", "30")."""
        kw = {}
        for name in ("with_text_content", "with_html_content", "prefer_html_content", "with_attachments",
                     "with_striptags_from_textcontent", "with_flag_sync", "keep_expunged_messages"):
            if name in settings:
                kw[name] = _bool(settings[name])
        if "headers_to_fields" in settings:
            kw["headers_to_fields"] = tuple(settings["headers_to_fields"] or ())
        for name in ("folderpattern", "mail_index_name", "mail_type_name", "mail_index_name_strategy"):
            if settings.get(name) is not None:
                kw[name] = str(settings[name])
        if settings.get("interval") is not None:
            iv = str(settings["interval"]).strip()
            m = re.fullmatch(r"(\d+)\s*(ms|s|m|h)?", iv)
            if m:
                unit = {"ms": "milliseconds", "s": "seconds", "m": "minutes", "h": "hours", None: "milliseconds"}[m.group(2)]
                iv = f"{m.group(1)} {unit}"
            kw["interval"] = iv
        opts = MailOptions(**kw)
        validate_pattern(opts.folderpattern)
        return opts
