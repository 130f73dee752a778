"""Word lists, lookup tables, patterns and thresholds used as defaults.

Every operator takes these as parameters; a caller may pass its own.
"""

# ---------------------------------------------------------------------------
# Fixed values. They define the results, so they are stated as they are.
# ---------------------------------------------------------------------------

# Query tokenizer: words that carry no match information
STOP_WORDS = (
    "a", "an", "the", "in", "on", "at", "for", "to", "of", "and", "or",
    "is", "are", "was", "be", "with", "by", "from", "as", "it", "i",
    "not", "how", "what", "why", "when", "where", "error", "vs",
    "get", "cannot", "can", "could", "that", "this", "these", "those",
    "using", "use", "via", "make", "do", "did", "does", "my",
)
GENERIC_SERVICE_WORDS = ("api", "service", "app", "cli", "sdk")

# Query token -> service, query token -> component
SERVICE_MAP = {
    "aws": "AWS", "amazon": "AWS", "terraform": "Terraform", "azure": "Azure", "gcp": "GCP",
    "firebase": "Firebase", "firestore": "Firebase", "docker": "Docker",
    "kubernetes": "Kubernetes", "k8s": "Kubernetes", "kubectl": "Kubernetes",
    "helm": "Kubernetes", "nginx": "Nginx", "github": "GitHub API", "gitlab": "GitLab",
    "openai": "OpenAI API", "chatgpt": "OpenAI API", "gemini": "Gemini API",
    "fastapi": "FastAPI", "flask": "Flask", "django": "Django", "redis": "Redis",
    "postgres": "PostgreSQL", "postgresql": "PostgreSQL", "mysql": "MySQL",
    "mongodb": "MongoDB", "minikube": "Minikube", "ansible": "Ansible",
    "jenkins": "Jenkins", "circleci": "CircleCI", "vercel": "Vercel",
    "netlify": "Netlify", "supabase": "Supabase", "stripe": "Stripe",
}
COMPONENT_MAP = {
    "iam": "IAM", "s3": "S3", "ec2": "EC2", "lambda": "Lambda", "rds": "RDS",
    "cloudfront": "CloudFront", "vpc": "VPC", "oidc": "OIDC", "jwt": "JWT", "oauth": "OAuth",
    "cors": "CORS", "ssl": "SSL", "tls": "TLS", "compose": "Compose", "registry": "Registry",
    "ingress": "Ingress", "rbac": "RBAC", "actions": "Actions", "webhook": "Webhook",
    "sts": "STS", "graphql": "GraphQL",
}
# Suggested-title rules, first match wins: words, title ending
TITLE_CODE_ENDING = " エラー：原因と解決策"
TITLE_RULES = (
    (("access denied", "permission", "forbidden", "unauthorized", "auth"),
     " 認証・権限エラー：原因と解決策"),
    (("timeout", "connection", "refused", "unreachable", "connect"),
     " 接続・タイムアウトエラー：解決方法"),
    (("not found", "missing", "404"), " Not Found エラー：原因と解決策"),
    (("rate limit", "quota", "throttl", "429"), " レート制限エラー：対処法"),
    (("ssl", "tls", "certificate", "cert"), " SSL/TLS エラー：解決方法"),
)
TITLE_OTHER_ENDING = " エラー：トラブルシューティングガイド"

# Search-query hygiene
QUERY_PUNCTUATION = "+\\-$#*_~|/\\\\:;,.、。．・!！?？()\\[\\]{}<>「」『』【】"
SHORT_QUERIES = (
    "bashとは", "bash とは", "docker compose", "docker-compose", "http 401", "http 403",
    "http 404", "http 429", "http 500", "http 503",
)
ERROR_DUMP_PHRASES = ("the model returned", "data retention mode", "traceback", "stack trace")
CODE_WORDS = ("const", "let", "var", "require", "import", "function", "=>")
VAGUE_QUERIES = ("cliとは", "cli コマンド", "cli", "apiとは")

# Error-text masking: pattern, mark (applied in order to lower-case text)
MASK_PATTERNS = (
    ("　", " "), ("[“”]", "\""), ("[‘’]", "'"),
    ("https?://\\S+", " <url> "),
    ("\\b\\d{1,3}(?:\\.\\d{1,3}){3}\\b", " <ip> "),
    ("[a-f0-9]{12,}", " <id> "),
    ("[a-z]:\\\\[^\\s]+", " <path> "),
    ("/[^\\s]+(?:/[^\\s]+)+", " <path> "),
    ("[<>{}()\\[\\],:;]+", " "), ("\\s+", " "),
)

# URL provenance tiers
OFFICIAL_HOSTS = (
    "docs.docker.com", "docs.github.com", "docs.gitlab.com",
    "docs.aws.amazon.com", "aws.amazon.com",
    "cloud.google.com", "firebase.google.com",
    "learn.microsoft.com", "docs.microsoft.com", "azure.microsoft.com",
    "kubernetes.io", "helm.sh", "docs.ansible.com", "nginx.org", "nginx.com",
    "docs.python.org", "devdocs.io", "developer.mozilla.org",
    "vercel.com", "docs.vercel.com", "supabase.com", "docs.supabase.com",
    "stripe.com", "docs.stripe.com", "openai.com", "platform.openai.com",
    "developers.google.com", "registry.terraform.io", "developer.hashicorp.com",
)
OFFICIAL_PREFIXES = ("docs.", "developer.", "developers.", "dev.", "learn.")
SEMI_OFFICIAL_HOSTS = ("ietf.org", "w3.org", "rfc-editor.org", "whatwg.org")
COMMUNITY_HOSTS = (
    "stackoverflow.com", "superuser.com", "serverfault.com",
    "github.com", "gitlab.com", "reddit.com",
)
PERSONAL_HOSTS = ("qiita.com", "zenn.dev", "dev.to", "note.com", "medium.com")
PERSONAL_SUFFIXES = (".hatenablog.com", ".hatenablog.jp", ".hatena.ne.jp")
REDIRECT_HOSTS = ("vertexaisearch.cloud.google.com",)
REDIRECT_PREFIXES = ("vertexaisearch.",)

# Resolved-domain table: tool -> official domains
TOOL_DOMAINS = {
    "Docker": ("docs.docker.com", "docker.com"),
    "Docker Compose": ("docs.docker.com", "docker.com"),
    "Firebase": ("firebase.google.com", "cloud.google.com"),
    "AWS": ("docs.aws.amazon.com", "aws.amazon.com"),
    "GitHub API": ("docs.github.com", "github.blog"),
    "OpenAI API": ("platform.openai.com", "developers.openai.com", "help.openai.com"),
    "Azure": ("learn.microsoft.com", "azure.microsoft.com"),
    "GCP": ("cloud.google.com", "developers.google.com"),
    "GitLab": ("docs.gitlab.com",),
    "Supabase": ("supabase.com",),
    "Vercel": ("vercel.com",),
    "Nginx": ("nginx.org", "docs.nginx.com"),
    "Stripe": ("docs.stripe.com", "stripe.com"),
    "Terraform": ("developer.hashicorp.com", "registry.terraform.io"),
    "Ansible": ("docs.ansible.com",),
    "Kubernetes": ("kubernetes.io",),
    "Minikube": ("minikube.sigs.k8s.io",),
    "Podman": ("podman.io", "docs.podman.io", "podman-desktop.io"),
    "Slack": ("api.slack.com", "docs.slack.dev", "slack.dev"),
    "Bitbucket": ("support.atlassian.com", "developer.atlassian.com"),
}
VENDOR_COMMUNITY_DOMAINS = (
    "repost.aws", "community.openai.com", "community.atlassian.com",
    "discuss.google.dev", "community.crowdin.com",
)
VENDOR_COMMUNITY_PREFIXES = ("forums.", "discuss.", "community.")
COMMUNITY_BLOG_DOMAINS = (
    "stackoverflow.com", "qiita.com", "zenn.dev", "medium.com", "github.com", "dev.to",
)
UNVERIFIABLE_DOMAINS = ("reddit.com", "redd.it", "vertexaisearch.cloud.google.com")
OTHER_DOMAINS = ("youtube.com", "youtu.be")

# Host tables in order of precedence: kind, match, values. Matches: "starts" (host
# starts with), "label" (first label with its dot), "exact", "under" (the domain or a
# subdomain of it), "ends".
TIER_TABLE = (
    ("grounding_redirect", "starts", REDIRECT_PREFIXES),
    ("grounding_redirect", "exact", REDIRECT_HOSTS),
    ("official", "exact", OFFICIAL_HOSTS), ("official", "starts", OFFICIAL_PREFIXES),
    ("semi_official", "exact", SEMI_OFFICIAL_HOSTS), ("community", "exact", COMMUNITY_HOSTS),
    ("personal", "exact", PERSONAL_HOSTS), ("personal", "ends", PERSONAL_SUFFIXES),
)
RESOLVED_TABLE = (
    ("vendor_community", "label", VENDOR_COMMUNITY_PREFIXES),
    ("vendor_community", "under", VENDOR_COMMUNITY_DOMAINS),
    ("official", "under", tuple(sorted({d for ds in TOOL_DOMAINS.values() for d in ds}))),
    ("unverifiable", "under", UNVERIFIABLE_DOMAINS),
    ("community_blog", "under", COMMUNITY_BLOG_DOMAINS), ("other", "under", OTHER_DOMAINS),
)

# Disqualifying phrases (rule B2): label, pattern
DISQUALIFIERS = (
    ("error_not_directly_handled",
     "直接的?な?(?:HTTP)?エラー(?:コード|メッセージ)?(?:を)?(?:直接)?扱(?:う|っている)?わけではありませ(?:ん|んが)"),
    ("soft_error_framing", "エラーとして捉えることができ(?:る|ます)"),
    ("no_specific_error_code", "特定の(?:HTTP)?エラーコードを直接"),
    ("not_http_status_related", "HTTP(?:ステータス)?コードに直結するものではなく"),
    ("indirect_error_message", "直接的なエラーメッセージとして現れること"),
)
FOOTER_MARK = "免責事項"
LEAD_HEADING = "(?m)^#{1,4}\\s*冒頭まとめ"
NOTE_HEADING = "(?i)^#{1,4}\\s*Editor['’]?s?\\s*Note"

# Secret tokens (rule C1): rule, prefix, minimum suffix length
SECRET_PREFIXES = (
    ("slack_bot", "xoxb-", 8), ("slack_user", "xoxp-", 8), ("slack_app", "xapp-", 8),
    ("openai_proj", "sk-proj-", 20), ("openai", "sk-(?!proj-)", 30),
    ("stripe_sk_live", "sk_live_", 10), ("stripe_pk_live", "pk_live_", 10),
    ("stripe_rk_live", "rk_live_", 10), ("stripe_sk_test", "sk_test_", 10),
    ("stripe_pk_test", "pk_test_", 10), ("aws_access", "AKIA", 16),
    ("github_token", "ghp_", 10), ("github_pat", "github_pat_", 10), ("gitlab", "glpat-", 10),
)
PLACEHOLDER_WORDS = (
    "your", "xxx", "xxxx", "here", "placeholder", "example", "dummy", "sample", "redacted",
    "api", "key", "bot", "token", "user", "secret", "auth", "access",
    "admin", "app", "client", "server", "test", "prod", "dev", "old",
    "new", "expired", "invalid", "bad", "good", "jwt", "bearer",
    "oauth", "pass", "password", "value", "string", "name", "id",
    "type", "scope", "role", "slug", "mytoken", "mykey", "myapp",
)
CONTEXT_KEYS = (
    "aws_secret_access_key", "aws_secret_key", "secret_access_key", "secretAccessKey",
    "SecretAccessKey", "AWS_SECRET_ACCESS_KEY", "secret_key",
)
CONTEXT_PLACEHOLDERS = ("your", "placeholder", "example", "dummy", "sample", "redacted")

# Topic and wording flags
HIGH_CHANGE_TERMS = (
    "api", "cloud", "aws", "azure", "gcp", "firebase", "openai", "gemini",
    "security", "oauth", "iam", "kubernetes", "docker", "terraform", "stripe",
    "pricing", "price", "law", "legal", "incident", "料金", "価格", "法律",
    "法令", "障害", "セキュリティ", "クラウド", "認証",
)
CRITICAL_TERMS = (
    "law", "legal", "finance", "medical", "investment", "diagnosis",
    "vulnerability", "credential", "secret", "private key", "access token",
    "法律", "金融", "医療", "投資", "診断", "脆弱性",
)
DANGEROUS_PATTERNS = (
    "rm\\s+-rf\\s+/", "chmod\\s+777", "curl\\s+[^|]+[|]\\s*(?:sh|bash)",
    "--no-check-certificate", "verify\\s*=\\s*false",
)
ABSOLUTE_WORDING = "必ず|絶対|100%|完全に|always|never"
OUTDATED_WORDING = "20(1[0-9]|2[0-4])|古い|廃止|deprecated|legacy"
CLAIM_WORDS = ("must", "should", "can", "will", "error", "status", "api", "token", "security")
CLAIM_ENDINGS = ("です", "ます", "必要", "原因", "解決", "設定", "認証", "権限", "エラー", "できます")
IMPORTANT_SENTENCE = (
    "概要|原因|解決|注意|権限|認証|セキュリティ|削除|料金|価格|API|仕様|"
    "error|cause|solution|security|permission|delete|remove|pricing|version|"
    "\\b\\d{3}\\b|20\\d{2}|v\\d+(?:\\.\\d+)?|必ず|絶対|must|should|never|always")
HEADING_WORDS = "概要|原因|解決|対策|注意|手順|エラー|solution|cause|fix"
LONG_CODE_LANGUAGES = (
    "bash", "sh", "shell", "json", "yaml", "yml", "docker", "dockerfile")

# Error-text categories, first match wins (compared in lower case)
ERROR_CATEGORIES = (
    ("quota", ("RESOURCE_EXHAUSTED", "quota exceeded", "rate limit", "billing", "429")),
    ("model", ("NOT_FOUND", "model is not found", "not supported for generateContent",
               "API key not valid", "permission denied")),
    ("timeout", ("Timeout", "ReadTimeout", "ConnectTimeout", "TimeoutException", "RetryError",
                 "ConnectionError", "timed out", "gemini timeout")),
    ("api", ("Tool use with a response mime type", "response mime type",
             "application/json is unsupported", "INVALID_ARGUMENT",
             "external fact check unavailable", "gemini_error")),
)

# Feed keywords
INCIDENT_KEYWORDS = (
    "incident", "outage", "degraded", "disruption", "investigating",
    "partial outage", "major outage", "service disruption",
    "障害", "停止", "サービス停止", "調査中", "復旧", "影響",
)
TECH_KEYWORDS = (
    "docker", "firebase", "aws", "github", "kubernetes", "k8s",
    "terraform", "hashicorp", "gcp", "google cloud", "cloudflare",
    "vercel", "nextjs", "openai", "anthropic", "llm",
    "ci/cd", "github actions", "nginx", "redis", "postgresql", "postgres",
)
ERROR_SIGNALS = (
    "error", "failed", "failure", "exception", "bug", "crash", "broken",
    "issue", "fix", "patch", "vulnerability", "cve", "incident", "outage",
    "timeout", "deadlock", "memory leak", "regression", "hotfix",
    "panic", "oom", "rate limit", "429", "500", "503",
    "エラー", "失敗", "不具合", "バグ", "障害", "脆弱性",
)
TITLE_STOP_WORDS = ("The", "An", "A", "In", "On", "Is", "Are", "Was", "Has")

# Term mining
TERM_STOP_WORDS = (
    "エラー", "コード", "ページ", "サービス", "ユーザー", "データ",
    "ファイル", "フォルダ", "システム", "アプリ", "サーバー", "クライアント",
    "メッセージ", "ログ", "パス", "URL", "ID", "OK", "NG", "UI", "OS",
    "PC", "IT", "IP", "HTTP", "NULL", "EOF", "AND", "NOT", "FOR",
    "THE", "GET", "SET", "PUT", "POST", "AWS", "GCP", "API",
)

# Label normalization: the two canonical labels
BEFORE_LABEL = "**Before（エラーが起きるコード）：**"
AFTER_LABEL = "**After（修正後）：**"

# Index groups: first kana of each row; other scripts fold to these
KANA_ROWS = (
    ("あ", "あいうえお"), ("か", "かきくけこ"), ("さ", "さしすせそ"), ("た", "たちつてと"),
    ("な", "なにぬねの"), ("は", "はひふへほ"), ("ま", "まみむめも"), ("や", "やゆよ"),
    ("ら", "らりるれろ"), ("わ", "わをん"),
)
KATAKANA = "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワヲン"
HIRAGANA = "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわをん"
VOICED_KATAKANA = "ァィゥェォガギグゲゴザジズゼゾダヂヅデドバビブベボパピプペポ"
VOICED_PLAIN = "あいうえおかきくけこさしすせそたちつてとはひふへほはひふへほ"

# Source types by declared quality
HIGH_QUALITY_TYPES = ("official", "documentation", "government", "academic", "company")
LOW_QUALITY_TYPES = ("blog", "other", "unknown", "")

# Score gates: live and audit presets
LIVE_GATE = {"factual": ("min", 75), "citation": ("min", 15), "risk": ("max", 55)}
AUDIT_GATE = {"factual": ("min", 75), "freshness": ("min", 50),
              "citation": ("min", 10), "risk": ("max", 55)}
