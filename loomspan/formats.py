"""Texts of the evidence document that every reader relies on."""

# Limits, headings and sentences of the document's format.
BODY_LIMIT = 30_000
ACTIVITY_BODY_LIMIT = 12_000
UNKNOWN_ACTIVITY = "Matched by GitHub updated_at search, but the exact activity could not be determined without timeline events."
FAILED_CHILD = "Could not collect "
DETAIL_FIELDS = ("title", "html_url", "state", "user", "created_at", "updated_at")
CHILD_KINDS = ("comment", "review", "review_comment")
DECISIVE = ("APPROVED", "CHANGES_REQUESTED", "DISMISSED")
TOP_SECTIONS = (
    "## Document Map",
    "## Collection Summary",
    "## Issues Index",
    "## Pull Requests Index",
    "## Issue Evidence",
    "## Pull Request Evidence",
    "## Collection Warnings",
    "## Data Limitations",
)
ISSUE_COLUMNS = "| ID | Repository | Number | Title | State | Created in period | Closed in period | Period human activity | Author association | Labels | Section |\n| --- | --- | ---: | --- | --- | --- | --- | ---: | --- | --- | --- |"
PULL_COLUMNS = "| ID | Repository | Number | Title | State | Created in period | Closed unmerged in period | Merged in period | Period human activity | Author association | Labels | Section |\n| --- | --- | ---: | --- | --- | --- | --- | --- | ---: | --- | --- | --- |"
DOCUMENT_MAP = """Recommended segmented reading order:

1. Read the front matter and Collection Summary.
2. Read the Issues Index and Pull Requests Index.
3. Select candidate items using index facts only.
4. Search for the exact `ITEM_START` marker and read through its matching `ITEM_END` marker.
5. Read related item blocks before forming a cross-item theme.
6. Finish with Collection Warnings and Data Limitations.

Do not assume this document must be loaded in one pass."""
LIMITATIONS = """- Candidate discovery uses GitHub Search Issues with the unexpanded UTC+8 calendar dates, followed by exact timestamp filtering.
- GitHub Search can expose at most 1,000 results for a query. A warning is recorded when that boundary is reached.
- Timeline events are not collected. Label, assignee, milestone, reopen, and draft-to-ready transition times cannot be determined.
- Search `updated_at` is used only for candidate discovery. An item is excluded when no collected creation, close, merge, comment, or review event falls in the period. This prevents branch deletion and other unexplained metadata updates from becoming inclusion reasons.
- Items without a verifiable period event are also excluded when an activity endpoint fails. These are counted separately because the failed endpoint may have hidden qualifying activity; inspect Collection Warnings for the affected item and request URL.
- Check runs and workflow runs are not collected. This evidence cannot determine CI status or merge readiness.
- Commits and changed-file diffs are not collected. This evidence cannot determine when a commit was pushed or what individual files changed.
- Reaction details are not collected.
- Pull request `mergeable` is GitHub's current nullable value and is not proof that a pull request is ready to merge.
- Bodies are truncated at 30,000 characters and individual activity bodies at 12,000 characters, with explicit markers.
- Comment and review-comment endpoints request records updated since the UTC+8 scan boundary. Older context can therefore be absent; when returned, at most the latest three pre-period human activities are shown."""
ISSUE_TRIAGE = (
    "#### Metadata",
    "#### Activity During Scan Period",
    "#### Labels, Assignees and Milestone",
    "#### Latest Human Comment",
    "#### Latest Maintainer Comment",
    "#### Data Gaps",
)
PULL_TRIAGE = (
    "#### Metadata",
    "#### Activity During Scan Period",
    "#### Current Review Information",
    "#### Labels, Assignees and Requested Reviewers",
    "#### Change Size",
    "#### Latest Human Activity",
    "#### Latest Maintainer Activity",
    "#### Data Gaps",
)
ISSUE_SECTIONS = (
    "#### Metadata",
    "#### Activity During Scan Period",
    "#### Labels, Assignees and Milestone",
    "#### Body",
    "#### Previous Context",
    "#### Comments During Scan Period",
    "#### Latest Human Comment",
    "#### Latest Maintainer Comment",
    "#### Data Gaps",
)
PULL_SECTIONS = (
    "#### Metadata",
    "#### Activity During Scan Period",
    "#### Current Review Information",
    "#### Labels, Assignees and Requested Reviewers",
    "#### Change Size",
    "#### Body",
    "#### Previous Context",
    "#### Conversation Comments During Scan Period",
    "#### Reviews During Scan Period",
    "#### Review Comments During Scan Period",
    "#### Latest Human Activity",
    "#### Latest Maintainer Activity",
    "#### Data Gaps",
)
ISSUE_VIEWS = {"body": "#### Body", "previous_context": "#### Previous Context", "comments": "#### Comments During Scan Period"}
PULL_VIEWS = {
    "body": "#### Body",
    "previous_context": "#### Previous Context",
    "comments": "#### Conversation Comments During Scan Period",
    "reviews": "#### Reviews During Scan Period",
    "review_comments": "#### Review Comments During Scan Period",
}
