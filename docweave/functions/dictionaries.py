"""Keyword dictionaries, domain sets and defaults.

Every operator takes a :class:`Dictionaries` instance, so a caller can pass
its own vocabulary (tests do, to reach branches the default words never hit
on the synthetic prose).  The defaults below are fixed values: they must
equal the behaviour being reproduced, so they are stated verbatim, in their
natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the reproduced behaviour; natural order)
# ---------------------------------------------------------------------------

AI_TOPIC_KEYWORDS: dict[str, tuple[str, ...]] = {
    "technology": (
        "llm", "transformer", "diffusion", "multimodal", "agent", "model",
        "neural network", "inference", "fine-tuning", "embedding", "rag",
        "vector database",
    ),
    "use_case": (
        "chatbot", "copilot", "automation", "customer support", "coding assistant",
        "recommendation", "workflow", "productivity", "analytics", "application",
        "deployment",
    ),
    "impact": (
        "impact", "adoption", "productivity gain", "job market", "economic", "society",
        "education", "healthcare", "sustainability", "future", "trend",
    ),
    "research": (
        "paper", "benchmark", "state of the art", "sota", "experiment", "arxiv",
        "evaluation", "dataset",
    ),
    "regulation": (
        "regulation", "governance", "policy", "compliance", "ai act", "risk management",
    ),
    "ethics": (
        "bias", "fairness", "transparency", "safety", "alignment", "privacy",
        "responsible ai",
    ),
    "business": (
        "startup", "investment", "funding", "roi", "enterprise", "strategy", "market",
        "revenue",
    ),
}

BLOG_DOMAINS = (
    "medium.com", "www.medium.com", "substack.com", "www.substack.com", "dev.to",
    "hashnode.com", "www.hashnode.com", "blog.google", "anthropic.com",
    "www.anthropic.com", "openai.com", "www.openai.com",
)

NEWS_DOMAINS = (
    "techcrunch.com", "www.techcrunch.com", "venturebeat.com", "www.venturebeat.com",
    "theverge.com", "www.theverge.com", "wired.com", "www.wired.com", "reuters.com",
    "www.reuters.com", "news.ycombinator.com",
)

RESEARCH_DOMAINS = (
    "arxiv.org", "export.arxiv.org", "huggingface.co", "www.semanticscholar.org",
    "semanticscholar.org", "paperswithcode.com", "www.paperswithcode.com",
)

JOB_DOMAINS = (
    "linkedin.com", "www.linkedin.com", "jobs.lever.co", "boards.greenhouse.io",
    "wellfound.com", "www.wellfound.com", "ashbyhq.com", "www.ashbyhq.com",
    "remotive.com", "www.remotive.com", "jobs.ashbyhq.com",
)

NEWS_SIGNAL_KEYWORDS = (
    "announced", "breaking", "report", "reported", "press release", "news", "today",
    "this week", "according to", "launches", "launching",
)

JOB_SIGNAL_TITLE_KEYWORDS = (
    "engineer", "scientist", "researcher", "applied ai", "machine learning",
    "ml engineer", "ai engineer", "llm engineer", "genai engineer", "hiring",
    "career", "job",
)

CONTENT_KIND_KEYWORDS: dict[str, tuple[str, ...]] = {
    "news": (
        "news", "announced", "launch", "released", "report", "update", "breaking",
        "press release",
    ),
    "use_case": (
        "use case", "case study", "implementation", "customer story", "how we use",
        "workflow", "production",
    ),
    "project": (
        "github", "repository", "open source", "framework", "library", "sdk", "tooling",
    ),
    "job_market": (
        "hiring", "vacancy", "open role", "open position", "recruiting", "job opening",
        "career",
    ),
    "impact": (
        "impact", "market demand", "adoption", "productivity", "future direction", "trend",
    ),
}

JOB_ROLE_KEYWORDS = (
    "machine learning engineer", "ml engineer", "ai engineer", "llm engineer",
    "genai engineer", "agentic ai engineer", "data scientist", "nlp engineer",
    "research scientist", "applied scientist", "prompt engineer", "ai product manager",
    "mlops engineer",
)

JOB_MARKET_KEYWORDS = (
    "hiring", "recruiting", "vacancy", "open role", "open position", "job opening",
    "salary", "compensation", "remote", "full-time", "part-time", "internship",
    "headcount",
)

SOCIAL_DOMAINS = (
    "linkedin.com", "www.linkedin.com", "x.com", "www.x.com", "twitter.com",
    "www.twitter.com", "reddit.com", "www.reddit.com",
)

CURATED_SOURCE_LINKS: dict[str, tuple[str, ...]] = {
    "blogs": (
        "https://www.anthropic.com/news",
        "https://www.anthropic.com/engineering",
        "https://medium.com/nlplanet",
        "https://odsc.medium.com",
        "https://medium.com/artificial-corner",
        "https://openai.com/index",
        "https://blog.google/technology/ai/",
    ),
    "github": (
        "https://github.com/topics/artificial-intelligence",
        "https://github.com/topics/llm",
        "https://github.com/topics/ai-agents",
        "https://github.com/topics/machine-learning",
    ),
    "news": (
        "https://www.wsj.com/tech/ai",
        "https://www.wired.com/tag/artificial-intelligence/",
        "https://timesofindia.indiatimes.com/technology",
        "https://www.theverge.com/ai-artificial-intelligence",
    ),
    "research_papers": (
        "https://arxiv.org/list/cs.AI/recent",
        "https://arxiv.org/list/cs.LG/recent",
        "https://arxiv.org/list/cs.CL/recent",
        "https://arxiv.org/list/cs.IR/recent",
    ),
    "job_postings": (
        "https://www.linkedin.com/jobs",
    ),
}

# Words added to a topic's keyword list when the topic mentions AI.
TOPIC_AI_EXPANSION = (
    "ai", "artificial intelligence", "machine learning", "generative ai", "agentic ai",
    "llm", "foundation model",
)

# Discovery walks categories in this order; the store lists collections in
# the second order (lookups and the analytics union follow it).
DISCOVERY_CATEGORY_ORDER = ("blogs", "github", "job_postings", "news", "research_papers")
COLLECTION_ORDER = ("blogs", "news", "github", "research_papers", "job_postings")

# Path fragments that mark a link as navigation rather than content.
BLOCKED_LINK_TOKENS = (
    "/tag/", "/tags/", "/author/", "/authors/", "/about", "/privacy", "/subscribe",
    "/login", "/signin", "/search",
)

# First path segments on the code host that are not repositories.
BLOCKED_REPO_SEGMENTS = (
    "topics", "orgs", "organizations", "explore", "resources", "articles", "blog",
    "marketplace", "settings", "login", "signup", "features", "collections",
    "trending", "readme", "about", "site", "enterprise", "customer-stories",
    "solutions", "events", "sponsors",
)

BINARY_FILE_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".ico", ".pdf", ".zip", ".tar",
    ".gz", ".7z", ".jar", ".bin", ".exe", ".so", ".dylib", ".dll", ".mp3", ".mp4",
    ".mov", ".avi", ".woff", ".woff2", ".ttf", ".otf", ".eot", ".pyc", ".class",
)

README_PREFERRED_NAMES = (
    "README.md", "README.rst", "README.txt", "README", "readme.md", "readme.rst",
    "readme.txt", "readme",
)

# Phrases of a bot-challenge page (any one), plus the pair that must co-occur.
CHALLENGE_PHRASES = (
    "performing security verification",
    "enable javascript and cookies to continue",
    "this website uses a security service to protect against malicious bots",
    "verification successful. waiting for",
)
CHALLENGE_PAIR = ("ray id", "cloudflare")

# Host -> extractor kind (anything else is an article).
EXTRACTOR_HOSTS = (
    ("github.com", "repository"),
    ("www.github.com", "repository"),
    ("linkedin.com", "job"),
    ("www.linkedin.com", "job"),
    ("medium.com", "feed_article"),
    ("www.medium.com", "feed_article"),
)

RESEARCH_PATH_TOKENS = ("/abs/", "/pdf/", "/paper", "/papers", "/research")
JOB_URL_TOKENS = ("job", "jobs", "career", "careers", "hiring", "position")
# The provisional (URL-only) category uses "positions" instead of "position".
PROVISIONAL_JOB_URL_TOKENS = ("job", "jobs", "careers", "career", "hiring", "positions")

CODE_HOSTS = ("github.com", "www.github.com")
PAPER_HOSTS = ("arxiv.org", "www.arxiv.org")
FEED_HOSTS = ("medium.com", "www.medium.com")

JOB_ANCHOR_CLASS = "base-card__full-link"
JOB_ANCHOR_HREF_PART = "/jobs/view/"

# Numeric defaults of the run (settings).
MAX_LINKS = 25
MIN_PER_CATEGORY = 5
JOB_PAGE_SIZE = 25
JOB_MAX_PAGES = 2
REPO_MAX_FILES = 120
REPO_MAX_FILE_CHARS = 4000
REPO_MAX_TOTAL_CHARS = 300000
REPO_SKIP_FILE_BYTES = 262144
MAX_CONTENT_CHARS = 25_000
MIN_CONTENT_CHARS = 120
MAX_SUMMARY_CHARS = 600
MAX_TAGS = 12
MAX_ANALYTICS_RESULTS = 10
DEFAULT_USER_FULL_NAME = "AI Engineer"
DEFAULT_TOPIC_QUERY = "agentic ai"
JOB_LOCATION = "Worldwide"
TRUNCATION_MARKER = "\n...[truncated]"
EMPTY_REPOSITORY = "No text content extracted from repository after ETL size and file filters."
SUMMARY_MARKER = "..."

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Dictionaries:
    """All vocabularies an enrichment run uses; override any for tests."""

    ai_topics: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(AI_TOPIC_KEYWORDS))
    content_kinds: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(CONTENT_KIND_KEYWORDS))
    job_roles: tuple[str, ...] = JOB_ROLE_KEYWORDS
    job_market: tuple[str, ...] = JOB_MARKET_KEYWORDS
    news_signals: tuple[str, ...] = NEWS_SIGNAL_KEYWORDS
    job_title_signals: tuple[str, ...] = JOB_SIGNAL_TITLE_KEYWORDS
    blog_domains: tuple[str, ...] = BLOG_DOMAINS
    news_domains: tuple[str, ...] = NEWS_DOMAINS
    research_domains: tuple[str, ...] = RESEARCH_DOMAINS
    job_domains: tuple[str, ...] = JOB_DOMAINS
    social_domains: tuple[str, ...] = SOCIAL_DOMAINS
    curated_links: tuple[str, ...] = tuple(
        link for links in CURATED_SOURCE_LINKS.values() for link in links
    )
    topic_ai_expansion: tuple[str, ...] = TOPIC_AI_EXPANSION

    def all_ai_keywords(self) -> list[str]:
        seen: list[str] = []
        for words in self.ai_topics.values():
            for w in words:
                if w not in seen:
                    seen.append(w)
        return seen


DEFAULT = Dictionaries()

# A vocabulary made of letter groups that do occur in the synthetic prose, so
# every scoring and classification branch is reached on the driver's tables.
TEST_VOCABULARY = Dictionaries(
    ai_topics={
        "technology": ("tion", "ment"),
        "use_case": ("able", "ther"),
        "impact": ("eau", "ver"),
        "research": ("sch", "ung"),
        "regulation": ("ción",),
        "ethics": ("ing ",),
        "business": ("llm", "roi", "rag", "trend"),
    },
    content_kinds={
        "news": ("ther", "eau"),
        "use_case": ("able",),
        "project": ("sch", "ung"),
        "job_market": ("ción",),
        "impact": ("ver", "trend"),
    },
    job_roles=("ción", "sch"),
    job_market=("trend", "rag"),
    news_signals=("eau",),
    job_title_signals=("ung",),
)
