"""Domain vocabulary: labels, classes, term lists and bucket boundaries.

Everything here is a default that callers may override by passing another
:class:`Vocab`.  Two instances ship:

* :data:`REFERENCE` -- the values the original application uses, so results
  equal its own;
* :data:`FIXTURE` -- English names used by the ``posts`` test view that is
  built from the given tables (see ``FIXTURES.md``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Vocab:
    # sentiment labels
    positive: str
    negative: str
    neutral: str
    # six day periods and their exclusive upper hour bounds (last one open)
    periods: tuple[str, str, str, str, str, str]
    period_bounds: tuple[int, int, int, int, int] = (6, 9, 12, 18, 22)
    # confidence levels: >= high_at, >= mid_at, else
    confidence_levels: tuple[str, str, str] = ("high", "medium", "low")
    high_at: float = 0.9
    mid_at: float = 0.7
    # identity
    default_auth: str = "ordinary user"
    official_flag_value: str = "official media"
    official_auth_substrings: tuple[str, ...] = ()
    official_name_patterns: tuple[str, ...] = ()
    # topic sets that give the personal bonus, one per cluster probability
    everyday_topics: tuple[str, ...] = ()
    night_topics: tuple[str, ...] = ()
    big_account_topics: tuple[str, ...] = ()
    venting_topics: tuple[str, ...] = ()
    # text rules
    spam_terms: tuple[str, ...] = ()
    promo_terms: tuple[str, ...] = ()
    promo_divisor: int = 8
    blocklist: tuple[str, ...] = ()
    sensitive_terms: tuple[str, ...] = ()
    # README-declared classes
    readme_periods: tuple[str, str, str, str, str] = (
        "night", "morning", "noon", "afternoon", "evening")
    auth_classes: tuple[str, str, str, str] = (
        "official", "institution", "celebrity", "ordinary")
    auth_class_markers: tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]] = (
        (), (), ())
    engagement_tiers: tuple[str, str, str, str] = ("viral", "high", "medium", "low")
    length_classes: tuple[str, str, str] = ("short", "medium", "long")
    post_tag_names: tuple[str, str, str] = ("topic", "mention", "plain")
    recall_reasons: tuple[str, str] = ("region", "time_period")
    # stand-in rule scorers (the original calls external models)
    positive_terms: tuple[str, ...] = ()
    negative_terms: tuple[str, ...] = ()
    topic_terms: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def with_(self, **kw) -> "Vocab":
        return replace(self, **kw)


# --- FIXED VALUES (must equal the original application's for equal results) ---
# Sentiment labels: positive, negative, neutral.
# Day periods, upper hour bounds 6/9/12/18/22, last open: 凌晨 早晨 上午 下午 晚间 午夜.
# Confidence levels (>=0.9, >=0.7, else): 高置信 中置信 低置信.
# Default identity class: 普通用户.  Official flag value: 官方媒体(蓝V).
# Official identity substrings: 官方 机构 蓝V.
# Official screen-name patterns: %官微% %融媒% %新闻% %发布%.
# Bonus topic sets: everyday 城市问题 民生服务; night 公众反馈/举报 城市问题;
#   big account 政务发布 公众反馈/举报; venting 公众反馈/举报.
# Spam terms, alternation order as given (抽奖 before 抽):
#   加V 抽奖 秒杀 代理 私信 领取 福利 红包 点击 下单 推广 包邮 免费 送 宝子 亲亲 抽 双11
# Promotion terms (divisor 8): 关注 转发 评论 点赞 进店 抢购 优惠 又好又便宜
REFERENCE = Vocab(
    positive="正面", negative="负面", neutral="中性",
    periods=("凌晨", "早晨", "上午", "下午", "晚间", "午夜"),
    confidence_levels=("高置信", "中置信", "低置信"),
    default_auth="普通用户",
    official_flag_value="官方媒体(蓝V)",
    official_auth_substrings=("官方", "机构", "蓝V"),
    official_name_patterns=("%官微%", "%融媒%", "%新闻%", "%发布%"),
    everyday_topics=("城市问题", "民生服务"),
    night_topics=("公众反馈/举报", "城市问题"),
    big_account_topics=("政务发布", "公众反馈/举报"),
    venting_topics=("公众反馈/举报",),
    spam_terms=("加V", "抽奖", "秒杀", "代理", "私信", "领取", "福利", "红包", "点击",
                "下单", "推广", "包邮", "免费", "送", "宝子", "亲亲", "抽", "双11"),
    promo_terms=("关注", "转发", "评论", "点赞", "进店", "抢购", "优惠", "又好又便宜"),
    blocklist=("常识打卡", "天猫", "京东", "淘宝", "拼多多", "肖战", "杨紫", "常识翻身打卡计划", "翻身打卡"),
)
# --- end FIXED VALUES ---

# The README declares a sensitive-term trend and identity classes without
# giving lists, and the sentiment / topic models are external services; the
# lists below (and the lexicons of the stand-in rule scorers) are our own choice.
REFERENCE = REFERENCE.with_(
    sensitive_terms=("投诉", "举报", "维权", "事故"),
    auth_class_markers=(("官方", "蓝V"), ("机构",), ("名人", "明星")),
    positive_terms=("点赞", "感谢", "满意", "支持", "好评"),
    negative_terms=("投诉", "差评", "愤怒", "失望", "举报"),
    topic_terms=(("城市问题", ("道路", "交通", "城管")), ("民生服务", ("医保", "社保", "教育")),
                 ("公众反馈/举报", ("投诉", "举报", "反映")), ("政务发布", ("通知", "公告", "发布"))),
)

# English vocabulary of the posts test view (FIXTURES.md section C).  The term
# lists are chosen so that each rule matches some of the given documents.
FIXTURE = Vocab(
    positive="positive", negative="negative", neutral="neutral",
    periods=("before dawn", "early morning", "morning", "afternoon", "evening", "late night"),
    default_auth="Ordinary user",
    official_flag_value="Official media",
    official_auth_substrings=("Official",),
    official_name_patterns=("%news%",),
    everyday_topics=("city", "livelihood"),
    night_topics=("feedback", "city"),
    big_account_topics=("government", "feedback"),
    venting_topics=("feedback",),
    spam_terms=("token", "free", "MIT", "share", "license"),
    promo_terms=("license", "share", "free", "token"),
    promo_divisor=8,
    blocklist=("Apache",),
    sensitive_terms=("token", "license", "free", "MIT"),
    auth_class_markers=(("Official",), ("Institution",), ("Celebrity",)),
    positive_terms=("and", "und", "les", "los"),
    negative_terms=("the", "der", "des", "nicht"),
    topic_terms=(("city", ("the", "ville")), ("livelihood", ("der", "die")),
                 ("feedback", ("les", "des", "token")), ("government", ("los", "las", "MIT"))),
)
