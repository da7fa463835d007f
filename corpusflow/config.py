"""Crawl and knowledge-base parameters.

A plain frozen dataclass of parameters passed to the DataFrame transforms.
Lists become small literal arrays inside column expressions, so they are
shipped with the plan rather than broadcast as tables.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- Fixed values: defaults that must equal the crawler being re-built ------
# Domains rejected by substring match on the lower-cased host.
DEFAULT_EXCLUDED_DOMAINS = (
    "facebook.com",
    "twitter.com",
    "instagram.com",
    "linkedin.com",
    "youtube.com",
)
# Host suffixes that are admitted; an empty list admits every host.
DEFAULT_ALLOWED_DOMAINS = (
    ".gc.ca",
    ".canada.ca",
)
# Path suffixes of binary / non-HTML assets that are rejected.
DEFAULT_EXCLUDED_EXTENSIONS = (
    ".pdf", ".png", ".jpg", ".jpeg", ".gif", ".svg",
    ".webp", ".ico", ".bmp", ".tiff", ".tif",
    ".mp4", ".mp3", ".wav", ".avi", ".mov",
    ".zip", ".tar", ".gz", ".rar",
    ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx",
)
# Elements whose whole subtree is dropped before any extraction.
DEFAULT_BOILERPLATE_TAGS = (
    "script", "style", "nav", "footer", "header", "aside", "noscript",
)
TRUNCATION_MARKER = "\n\n[Content truncated]"
NO_CONTENT = "(No content available)"
# Link caps: links kept per page, links handed back for a thin page, links
# sampled in the preview, characters of anchor text kept.
MAX_LINKS_PER_PAGE = 50
MAX_FOLLOW_LINKS = 20
SAMPLE_LINKS = 5
MAX_LINK_TEXT = 100
PREVIEW_CHARS = 2000
# Content override shorter than this is replaced by the cached page content.
CACHE_OVERRIDE_CHARS = 500
# Top-k of the retrieval fallback and characters of the snippet shown.
RETRIEVE_K = 5
SNIPPET_CHARS = 300
EMBED_DIM = 1024
# --- end of fixed values ---------------------------------------------------


@dataclass(frozen=True)
class CrawlPolicy:
    """Admission, extraction and storage parameters of one crawl session."""

    max_pages: int | None = 20       # None: no budget
    max_link_depth: int = 2
    request_delay: float = 1.0
    min_content_length: int = 200
    max_content_length: int = 50000
    respect_robots_txt: bool = True
    user_agent: str = "CorpusFlowCrawler/1.0 (corpus builder)"
    output_format: str = "markdown"
    key_prefix: str = "crawled-docs/"
    bucket: str | None = None
    excluded_domains: tuple[str, ...] = DEFAULT_EXCLUDED_DOMAINS
    allowed_domains: tuple[str, ...] = DEFAULT_ALLOWED_DOMAINS
    excluded_extensions: tuple[str, ...] = DEFAULT_EXCLUDED_EXTENSIONS
    boilerplate_tags: tuple[str, ...] = DEFAULT_BOILERPLATE_TAGS

    def with_(self, **kw) -> "CrawlPolicy":
        return replace(self, **kw)

    @property
    def agent_token(self) -> str:
        """Robots agent token: the product part of the user agent, lower case."""
        return self.user_agent.split("/")[0].lower()


def deployed_policy(n_seeds: int, **kw) -> CrawlPolicy:
    """The hosted path: budget of three pages per seed and a 0.5 s gap."""
    return CrawlPolicy(max_pages=3 * n_seeds, request_delay=0.5, **kw)


# Policy used against the generated test tables (hosts end in example.*).
TEST_POLICY = CrawlPolicy(
    max_pages=100,
    min_content_length=200,
    max_content_length=5000,
    allowed_domains=(".example.com", ".example.org"),
    excluded_domains=("spam-farm", "cheap-pills", "adult-x"),
    excluded_extensions=(".html",) + DEFAULT_EXCLUDED_EXTENSIONS,
)
# Thin-page threshold used by the table-of-contents tests.
TEST_THIN_LENGTH = 1500


@dataclass(frozen=True)
class ChunkConfig:
    """Chunking and embedding parameters of the knowledge base build."""

    size: int = 300          # words per chunk
    overlap: int = 60        # words shared by consecutive chunks
    dim: int = EMBED_DIM     # embedding width
    include_title: bool = False  # sidecar attribute flag includeForEmbedding


TEST_CHUNKS = ChunkConfig(size=300, overlap=60, dim=64)

# Fixed run timestamp used instead of now() so results are reproducible.
TEST_CRAWLED_AT = "2024-01-01 00:00:00.000001"
