"""Repository links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwork.functions.text import bind, py_strip

# Fixed value: what counts as a repository link.
REPO_LINK = r"(?i)https?://github\.com/([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)"


def github_owner_repo(url: Column) -> Column:
    """struct(owner, repo) of the first repository link in the text, or null."""
    def split(text: Column) -> Column:
        repo = F.regexp_replace(F.regexp_extract(text, REPO_LINK, 2), r"\.git$", "")
        pair = F.struct(F.regexp_extract(text, REPO_LINK, 1).alias("owner"), repo.alias("repo"))
        return F.when(text.rlike(REPO_LINK), pair)

    return bind(py_strip(url), split)


def repo_url(owner: Column, repo: Column) -> Column:
    return F.concat(F.lit("https://github.com/"), owner, F.lit("/"), repo)


def github_url_clean(url: Column, compat: bool = False) -> Column:
    """Canonical repository URL of the first link in the text, or null.

    `compat=True` trims any trailing run of the characters `.`, `g`, `i`, `t` from the
    repository name, as older data was produced; the default removes one `.git` suffix.
    """
    text = py_strip(url)
    repo = F.regexp_extract(text, REPO_LINK, 2)
    repo = F.rtrim(repo, F.lit(".git")) if compat else F.regexp_replace(repo, r"\.git$", "")
    return F.when(text.rlike(REPO_LINK), repo_url(F.regexp_extract(text, REPO_LINK, 1), repo))
