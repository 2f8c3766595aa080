"""Lexicons of the text operators. All are parameters; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# Rules, word lists and texts that results must equal.
PAIN_RULES = (
    ("不透气", ("不透气", "不透风", "闷热", "闷汗", "不通风", "憋闷")),
    ("太重", ("太重", "笨重", "沉重", "压身", "负重感")),
    ("不日透气常", ("不日透气常", "不日常", "不常穿", "难日常")),
    ("版型差", ("版型差", "版型不好", "版型怪", "显胖", "不合身", "剪裁差")),
    ("拉链问题", ("拉链问题", "拉链坏", "拉链卡", "拉锁", "拉链不顺", "拉链裂")),
    ("价格高", ("价格高", "太贵", "好贵", "性价比低", "不值", "买贵了", "贵死")),
    ("不耐磨", ("不耐磨", "起球", "易磨损", "不耐用", "质量差", "容易破")),
    ("不适合通勤", ("不适合通勤", "穿不出去", "没法通勤", "上班不能穿", "不实用")),
)
POSITIVE = ("好", "好看", "舒服", "舒适", "透气", "轻便", "轻", "满意", "喜欢", "推荐", "值得", "划算", "性价比", "耐穿", "耐磨", "百搭", "显瘦", "合身", "正品", "赞", "棒", "优秀", "完美", "惊艳", "回购", "爱了", "实用", "日常", "通勤")
NEGATIVE = ("难看", "不舒服", "失望", "后悔", "不推荐", "不值", "太贵", "好贵", "起球", "假货", "差评", "退款", "臃肿", "显胖", "不合身", "闷汗", "不透气", "笨重", "不实用", "买亏了", "质量差", "垃圾")
NEGATIVE_SINGLE = ("差", "闷", "贵", "破", "烂", "坑", "裂", "坏", "卡")
WEIGHT_NEGATIVE = ("太重", "很重", "厚重", "压身", "笨重", "沉重", "负重感", "好重", "太重了", "很沉", "偏沉", "有点沉", "太沉")
WEIGHT_NEGATIVE_SINGLE = ("沉",)
DESIGN_MAPPING = (
    ("不透气", "加强透气结构与通风设计", "透气膜 | 通风拉链 | 网眼内衬"),
    ("太重", "采用更轻量面料并优化裁片", "轻量尼龙 | 精简裁片 | 减少辅料克重"),
    ("不日透气常", "平衡户外性能与日常穿搭场景", "低调配色 | 可收纳帽 | 城市通勤口袋布局"),
    ("版型差", "优化版型与尺码梯度", "立体剪裁 | 多尺码梯度 | 肩腰比例调整"),
    ("拉链问题", "升级拉链五金与工艺质检", "YKK拉链 | 防水拉链 | 拉链挡片"),
    ("价格高", "明确价值点或提供更具竞争力的定价策略", "成本可视化 | 分层产品线 | 材料替代方案"),
    ("不耐磨", "提升耐磨面料与关键部位加固", "考杜拉 | 耐磨涂层 | 肘部膝部补强"),
    ("不适合通勤", "增加城市通勤友好的外观与收纳设计", "简约外观 | 电脑隔层 | 轻量通勤版型"),
)
COLOR = ("黑", "白色", "白", "灰", "军绿", "橄榄绿", "卡其", "藏青", "蓝", "红", "橙", "黄", "紫", "米白", "墨绿", "深灰", "浅灰", "军服绿", "撞色")
MATERIAL = ("尼龙", "gore", "tex", "防水", "防风", "软壳", "硬壳", "抓绒", "羽绒", "棉", "涤纶", "聚酯", "膜", "涂层", "ripstop", "考杜拉", "面料", "材质")
FIT = ("修身", "宽松", "oversize", "合身", "显瘦", "显胖", "版型", "剪裁", "直筒", "短款", "长款", "落肩", "收腰")
FUNCTION = ("透气", "防水", "防风", "保暖", "防寒", "速干", "耐磨", "轻量", "收纳", "多口袋", "反光", "可拆卸", "拉链", "帽檐", "压胶", "密封")
SCENARIO = ("通勤", "户外", "徒步", "登山", "城市", "日常", "露营", "骑行", "旅行", "上班", "街拍", "滑雪", "雨天", "冬季", "夏季")
GENERAL = ("机能风", "gorpcore", "gorp", "户外", "冲锋衣", "软壳", "硬壳", "穿搭", "始祖鸟", "萨洛蒙", "巴塔哥尼亚", "工装", "山系", "urban", "techwear")
ONTOLOGY_NAMES = ("颜色", "材质", "剪裁", "功能组件", "使用场景", "用户痛点")
NO_HITS_REASON = "未命中正负面词典"
POSITIVE_REASON = "正面词："
NEGATIVE_REASON = "负面词："
NEGATIVE_IMPLICATION = "关注用户负面反馈并迭代体验细节"
FUNCTION_IMPLICATION = "延续受欢迎功能："
COMMUTE_TERM = "通勤"
COMMUTE_IMPLICATION = "继续强化通勤场景的舒适与外观平衡"
NO_IMPLICATION = "暂无明显设计启示，建议结合更多样本"
VIDEO_PAIN = ("太热", "太重", "不日常", "不实用", "闷热", "笨重", "贵", "性价比", "不耐用", "穿不出去", "显胖", "不好搭", "买亏了", "后悔", "退款", "差评", "质量差", "起球")
DEFAULT_REVIEWS = ("系统默认好评", "默认好评", "此用户没有填写评价", "用户未及时做出评价", "评价方未及时")


@dataclass(frozen=True)
class Lexicon:
    """All lists that the text operators use."""

    pain_rules: tuple[tuple[str, tuple[str, ...]], ...] = PAIN_RULES
    positive: tuple[str, ...] = POSITIVE
    negative: tuple[str, ...] = NEGATIVE
    negative_single: tuple[str, ...] = NEGATIVE_SINGLE
    weight_negative: tuple[str, ...] = WEIGHT_NEGATIVE
    weight_negative_single: tuple[str, ...] = WEIGHT_NEGATIVE_SINGLE
    color: tuple[str, ...] = COLOR
    material: tuple[str, ...] = MATERIAL
    fit: tuple[str, ...] = FIT
    function: tuple[str, ...] = FUNCTION
    scenario: tuple[str, ...] = SCENARIO
    general: tuple[str, ...] = GENERAL
    design: tuple[tuple[str, str, str], ...] = field(default=DESIGN_MAPPING)
    commute_term: str = COMMUTE_TERM


DEFAULT = Lexicon()

#: A small Latin lexicon for text in the Latin script.
LATIN = Lexicon(
    pain_rules=(("legal", ("license", "copyright", "warranty")), ("insult", ("idiot", "pathetic", "stupid")), ("noise", ("%%%", "###", "&&&", "***"))),
    positive=("the ", "good", "with", "that", "great"),
    negative=("idiot", "pathetic", "%%%", "not "),
    negative_single=("no", "bad"),
    weight_negative=("heavy",),
    weight_negative_single=("of",),
    color=("red", "blue", "tion"),
    material=("th", "wh", "ing"),
    fit=("er", "est"),
    function=("and", "for", "from", "are"),
    scenario=("ciudad", "was", "sch"),
    general=("is", "the", "und", "les"),
    design=(("legal", "check terms", "terms | notices"), ("insult", "moderate tone", "filters"), ("noise", "repair text", "encoding | markup")),
    commute_term="was",
)
