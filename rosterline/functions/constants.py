"""Fixed values of the list data: labels, reasons, column contracts.

They are compared as text with existing master tables and ledgers, so they must not change.
"""

# --- sources -----------------------------------------------------------------------------
SRC_MOF = "財務省"
SRC_OFAC = "OFAC"
SRC_METI = "経産省"
SRC_MOFA = "外務省"
SRC_UK = "UK FCDO"
SRC_UNKNOWN = "legacy"
SOURCE_ORDER = {SRC_MOF: 0, SRC_METI: 1, SRC_MOFA: 2, SRC_OFAC: 3, SRC_UK: 4, SRC_UNKNOWN: 9}
OTHER_SOURCE_ORDER = 8

# --- master ------------------------------------------------------------------------------
MASTER_COLUMNS = [
    "match_key", "display_name", "status", "risk_type", "risk_level",
    "first_seen_ms", "last_updated_ms", "sources", "categories",
    "remark", "invalid_reason", "review_flag", "variants",
]
ACTIVE = "有効"
INACTIVE = "無効"
RISK_TYPE = "制裁リスト"
RISK_LEVEL = "高"
DELISTED = "全ての出所から掲載が無くなったため無効化（制裁解除または統廃合）"
WEAK_REASON = "OFAC現役Weak Aliasのため通常スクリーニング対象外"
WEAK_MULTI_REASON = "OFAC現役Weak Alias（複数Party）のため通常スクリーニング対象外"
WEAK_FLAG = "OFAC_WEAK_ALIAS_CURRENT"
WEAK_MULTI_FLAG = "OFAC_WEAK_ALIAS_MULTI_PARTY"
WEAK_REASONS = [WEAK_REASON, WEAK_MULTI_REASON]
WEAK_FLAGS = [WEAK_FLAG, WEAK_MULTI_FLAG]
REACTIVATABLE = [DELISTED, *WEAK_REASONS]

# --- 32-column list ----------------------------------------------------------------------
LIST_COLUMNS = [
    "区分", "番号", "告示日付", "告示番号", "個人・団体",
    "氏名（日本語）", "氏名（英語）",
    "別名・別称（日本語）", "別名・別称（英語）",
    "旧称（日本語）", "旧称（英語）",
    "確定に十分でない別名（日本語）", "確定に十分でない別名（英語）",
    "称号（日本語）", "称号（英語）", "役職（日本語）", "役職（英語）",
    "生年月日", "出生地（日本語）", "出生地（英語）",
    "国籍（日本語）", "国籍（英語）", "旅券番号", "身分証番号",
    "住所・所在地（国）（日本語）", "住所・所在地（都市その他の情報）（日本語）",
    "住所・所在地（国）（英語）", "住所・所在地（都市その他の情報）（英語）",
    "国連参照番号", "リスト掲載日", "その他の情報", "外務省告示情報",
]
NAME_COLUMNS = [
    "氏名（日本語）", "氏名（英語）",
    "別名・別称（日本語）", "別名・別称（英語）",
    "旧称（日本語）", "旧称（英語）",
    "確定に十分でない別名（日本語）", "確定に十分でない別名（英語）",
]
BIRTH_PLACE = ["出生地（日本語）", "出生地（英語）"]
NATIONALITY = ["国籍（日本語）", "国籍（英語）"]
ADDRESS = [
    "住所・所在地（国）（日本語）", "住所・所在地（都市その他の情報）（日本語）",
    "住所・所在地（国）（英語）", "住所・所在地（都市その他の情報）（英語）",
]
ADMIN_FIELDS = ["区分", "番号", "告示日付", "告示番号", "リスト掲載日"]
AGGREGATE_FIELDS = ["外務省告示情報"]
SUPPLEMENT_FIELDS = ["その他の情報"]
DATE_FIELDS = ["生年月日", "告示日付", "リスト掲載日"]
LOCATION_FIELDS = BIRTH_PLACE + ADDRESS
ECHO_FIELDS = [
    "称号（日本語）", "称号（英語）", "役職（日本語）", "役職（英語）", "生年月日",
    *BIRTH_PLACE, *NATIONALITY, "旅券番号", "身分証番号", *ADDRESS, "国連参照番号",
]
CASELESS_FIELDS = [
    "氏名（英語）", "別名・別称（英語）", "旧称（英語）", "確定に十分でない別名（英語）",
    "称号（英語）", "役職（英語）", "出生地（英語）", "国籍（英語）",
    "住所・所在地（国）（英語）", "住所・所在地（都市その他の情報）（英語）",
]
PRIMARY_NAME = ["氏名（日本語）", "氏名（英語）"]
STRONG_ALIAS = ["別名・別称（日本語）", "別名・別称（英語）"]
FORMER_NAME = ["旧称（日本語）", "旧称（英語）"]
WEAK_ALIAS = ["確定に十分でない別名（日本語）", "確定に十分でない別名（英語）"]
HIGH_TRIGGERS = [*PRIMARY_NAME, *STRONG_ALIAS, *FORMER_NAME, "旅券番号", "身分証番号"]
MEDIUM_TRIGGERS = ["生年月日", *BIRTH_PLACE, *NATIONALITY, *ADDRESS]
NULLISH = ["", "-", "‐", "―", "ー", "なし", "不明", "N/A", "n/a"]
DOCUMENT_MARKERS = ["発行", "失効", "有効", "issued", "expires", "expired", "expiry"]

IMPACT_AGGREGATE = "集約原文（重複）"
IMPACT_MOVED = "列再構成（既知情報）"
IMPACT_COSMETIC = "表記差"
IMPACT_ADMIN = "管理"
IMPACT_SUPPLEMENT = "補足情報・要レビュー"
IMPACT_IDENTITY = "識別・スクリーニング"

# --- removal queue -----------------------------------------------------------------------
PENDING = "PENDING_REVIEW"
APPLIED = "APPLIED"
CANCELLED = "CANCELLED_REAPPEARED"

# --- status table ------------------------------------------------------------------------
SOURCE_LABELS = {
    "mof": "財務省",
    "meti": "経済産業省",
    "ofac_sdn": "OFAC SDN",
    "ofac_cons": "OFAC Consolidated",
    "mofa_catalog": "外務省（現行リスト）",
    "mofa_press": "外務省（報道発表）",
}
STATUS_LABELS = {
    "fetched": "取得あり",
    "changed": "更新あり",
    "no_effective_change": "元データ更新・実質変更なし",
    "unchanged": "変更なし",
    "review_required": "掲載終了候補・要レビュー",
    "updated": "更新あり（要手動確認）",
    "blocked": "自動取得不可",
    "error": "エラー",
    "manual_ok": "手動監視（正常）",
    "manual_pending": "要確認：正本取得待ち",
    "manual_review": "要レビュー",
    "manual_approved": "要確認：反映待ち",
    "manual_critical": "重大：更新候補未検証",
    "manual_blocked": "重大：正本解析BLOCKED",
    "manual_rejected": "要確認：取込却下",
}
UNCHECKED = "未確認"
CHANGE_CAP = 5000

# --- manual lifecycle --------------------------------------------------------------------
TRANSITIONS = {
    "": ["CHECKED_NO_CHANGE", "DETECTED"],
    "CHECKED_NO_CHANGE": ["CHECKED_NO_CHANGE", "DETECTED"],
    "DETECTED": ["MANUAL_FETCH_REQUIRED"],
    "MANUAL_FETCH_REQUIRED": ["FILE_RECEIVED", "BLOCKED"],
    "FILE_RECEIVED": ["VALIDATED", "BLOCKED"],
    "VALIDATED": ["DIFFED", "BLOCKED"],
    "DIFFED": ["REVIEW_REQUIRED", "BLOCKED"],
    "REVIEW_REQUIRED": ["APPROVED", "REJECTED", "BLOCKED"],
    "APPROVED": ["APPLIED", "APPLIED_WITH_HOLDS", "BLOCKED"],
    "REJECTED": ["CHECKED_NO_CHANGE", "DETECTED"],
    "APPLIED": ["CHECKED_NO_CHANGE", "DETECTED"],
    "APPLIED_WITH_HOLDS": ["CHECKED_NO_CHANGE", "DETECTED"],
    "BLOCKED": ["FILE_RECEIVED", "REJECTED"],
}
TERMINAL_STATES = ["REJECTED", "APPLIED", "APPLIED_WITH_HOLDS"]
OPEN_STATES = ["DETECTED", "MANUAL_FETCH_REQUIRED", "FILE_RECEIVED", "VALIDATED"]
DIFFED_STATES = ["DIFFED", "REVIEW_REQUIRED", "APPROVED"]
CLOSED_STATES = ["CHECKED_NO_CHANGE", "REJECTED", "APPLIED", "APPLIED_WITH_HOLDS"]
