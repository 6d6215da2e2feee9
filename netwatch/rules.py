"""Rule sets, thresholds and weights. Everything here is data; the operators take it as arguments."""

from __future__ import annotations

# Attack rules on request_path. The first rule that matches wins.
BATCH_A = {
    "SQL_Injection": r"(?i)(' OR 1=1|UNION SELECT|sqlmap)",
    "XSS": r"(?i)(<script>|alert\()",
}
BATCH_B = {
    "SQL_Injection": r"(?i)(' OR 1=1|UNION SELECT|sqlmap|SELECT.*FROM|--)",
    "XSS": r"(?i)(<script>|alert\(|onerror)",
    "Command_Injection": r"(?i)(bin/sh|bin/bash|powershell|curl.*\|)",
}
NO_ATTACK = "Normal"

# Stream signatures, matched with case on request_path or user_agent.
SIGNATURES = (
    "sqlmap",
    "nikto",
    "OR 1=1",
    "UNION SELECT",
    "DROP TABLE",
    r"\.\./",
    "cmd=",
    r"eval\(",
    r"alert\(",
    "onload=",
    "etc/passwd",
)

# Fixed values: (type, column, pattern) of a stream signature. The first that matches wins.
SIGNATURE_TYPES = (
    ("scanner_tool", "user_agent", "sqlmap|nikto"),
    ("sqli", "request_path", "UNION|SELECT|DROP|OR 1=1"),
    ("xss", "request_path", "<script|alert|onload"),
)
OTHER_SIGNATURE = "signature_match"
SIGNATURE_SCORE = 0.9

# The action of a refused request, and what the path of a login contains.
REFUSED_ACTION = "blocked"
LOGIN_MARK = "login"

# Thresholds, score scales and window lengths.
FAILED_MIN = 5
FAILED_SCALE = 20.0
EXFIL_BYTES = 10_000_000
EXFIL_SCALE = 100_000_000.0
HIGH_RISK = 0.7
BRUTE_FORCE_WINDOW = "1 minute"
EXFIL_WINDOW = "10 seconds"
SCORE_WINDOW = "5 minutes"

# Weight of a label in tenths; any other label, or none, weighs OTHER_TENTHS.
LABEL_TENTHS = {"malicious": 10, "suspicious": 5}
OTHER_TENTHS = 1

# Labels that count as a threat, and the one that does not.
THREAT_LABELS = ("malicious", "suspicious")
BENIGN = "benign"

# Message key without a source address, kept versions, and time to live in seconds.
NO_SOURCE = "0.0.0.0"
PATTERN_VERSIONS = 5
THREAT_TTL_SECONDS = 86_400
