"""Two-valued flags of actors and activities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Logins of robots without the suffix, and associations that mark a maintainer.
BOT_LOGINS = ["dependabot", "github-actions", "renovate", "codecov", "mergify"]
MAINTAINERS = ["OWNER", "MEMBER", "COLLABORATOR"]


def is_bot(login: Column, kind: Column) -> Column:
    """By type (in exact case), by the suffix [bot], or by a known login; null is not a bot."""
    name = F.lower(F.coalesce(login, F.lit("")))
    return F.coalesce(kind == "Bot", F.lit(False)) | name.endswith("[bot]") | name.isin(BOT_LOGINS)


def is_maintainer(association: Column) -> Column:
    return F.coalesce(F.upper(association).isin(MAINTAINERS), F.lit(False))


def login_of(login: Column) -> Column:
    return F.coalesce(F.nullif(login, F.lit("")), F.lit("unknown"))


def is_active(in_period: Column, updated_in_period: Column) -> Column:
    return F.coalesce(in_period, F.lit(False)) | F.coalesce(updated_in_period, F.lit(False))
