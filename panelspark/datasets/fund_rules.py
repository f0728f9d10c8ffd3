"""Fund name rules: index name from fund name, sector, size, style and sector group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.operators.joins import contains_any, first_match

# Fund company names that start a fund name.
COMPANIES = (
    "华泰柏瑞 华夏 易方达 南方 嘉实 广发 富国 博时 招商 天弘 国泰 鹏华 汇添富 银华 工银瑞信 华安 景顺长城 万家 中欧 兴全 "
    "建信 平安 海富通 国联安 申万菱信 大成 信诚 泰达宏利 长盛 长信 东财 华宝 交银 前海开源 西部利得 浦银安盛 民生加银 中银 "
    "上投摩根 摩根 中信保诚 中信建投 中融 中金 东方 永赢 兴业 创金合信 泰康 中加 泓德 东海 红土创新 浙商 财通 方正富邦 "
    "西藏东财 惠升 山西证券 华商 汇安 信达澳亚 金鹰 新华 诺安 融通 长城 国投瑞银 银河 中海 德邦 鑫元 太平 淳厚 百嘉 安信 "
    "宝盈 蜂巢 贝莱德 路博迈 施罗德 联博 富达 宏利 弘毅远方 南华 华润元大 国寿安保 汇丰晋信 中银国际 国联 摩根士丹利 申万 "
    "华富 益民 东吴 泰信 光大保德信 中邮 东方阿尔法 合煦智远 博道 同泰 朱雀 睿远 湘财 先锋 兴银 长江 凯石 恒越 弘毅 惠理 "
    "圆信永丰 九泰"
).split()

# Sector code, sector name, keywords. The first keyword found in this order decides.
SECTORS = """
801150.SI 医药生物 医药 医疗 生物医药 创新药 中药 医疗器械 生物科技 疫苗 生物技术 健康产业 制药
801080.SI 电子 半导体 芯片 信息技术 信息 物联网 科创 TMT 虚拟现实 电子
801750.SI 计算机 计算机 软件 云计算 大数据 人工智能 AI 互联网 科技 数字经济 研发创新 车联网
801890.SI 机械设备 机器人 智能制造 工业4 工程机械 装备产业 机床 制造 高端装备 先进制造
801770.SI 通信 通信 5G 电信
801760.SI 传媒 传媒 游戏 影视
801120.SI 食品饮料 食品 饮料 白酒 酒 消费
801110.SI 家用电器 家电
801010.SI 农林牧渔 农业 畜牧 粮食 农牧
801130.SI 纺织服饰 品牌
801780.SI 银行 银行
801790.SI 非银金融 证券 保险 金融 券商 非银 财富管理
801180.SI 房地产 房地产 地产
801720.SI 建筑装饰 基建 一带一路 新丝路
801710.SI 建筑材料 材料
801740.SI 国防军工 军工 国防 航天 航空 卫星 通用航空 船舶
801880.SI 汽车 汽车 智能汽车 新能源车
801730.SI 电力设备 新能源 光伏 风电 电池 储能 电网设备 绿色能源 现代能源
801160.SI 公用事业 电力 公用事业
801970.SI 环保 碳中和 环保 低碳 长江保护 环境治理 可持续发展
801050.SI 有色金属 有色 稀土 黄金 贵金属 稀有金属 金属 矿产 资源 大宗商品
801950.SI 煤炭 煤炭
801040.SI 钢铁 钢铁
801030.SI 基础化工 化工
801960.SI 石油石化 油气 石油 天然气 石化 能源
801170.SI 交通运输 交通运输 物流 内地运输 高铁
801210.SI 社会服务 旅游 酒店 养老 教育
801200.SI 商贸零售 新零售
"""

# Sector group and its sectors.
GROUPS = """
周期 石油石化 煤炭 有色金属 钢铁 基础化工 建筑材料 建筑装饰 机械设备 电力设备 环保
消费 食品饮料 家用电器 农林牧渔 纺织服饰 轻工制造 商贸零售 社会服务 美容护理 医药生物 汽车
金融 银行 非银金融 房地产
成长 电子 计算机 传媒 通信 国防军工
稳定 交通运输 公用事业 综合
"""

# Sectors with a style other than blend, and sectors of large funds.
DIVIDEND_SECTORS = "银行 公用事业".split()
GROWTH_SECTORS = "电力设备 国防军工 汽车 计算机 电子 通信 传媒".split()
LARGE_SECTORS = "银行 公用事业".split()

# Words of broad, income, foreign and regional funds.
BROAD = (
    "上证50 上证180 上证380 上证580 上证综 上证中盘 上证中小 上证超级大盘 上证中央企业 上证国有企业 上证市值百强 上证民营企业 "
    "上证社会责任 上证周期 上证非周期 上证新兴产业 沪深300 中证100 中证A50 中证A100 中证A500 中证500 中证800 中证1000 中证2000 "
    "国证2000 中证全指 中证A股 中证流通 创业板 科创50 科创100 科创板 科创综指 科创创业 北证50 深证50 深证100 深证300 深证主板 "
    "深证成指 深证成份 深证成长 深证民营 深证基本面 中小板 中小企业 中创400 中证等权重 中证创业成长 基本面 中证优选 央视财经 "
    "国企改革 并购重组 国证大盘 国证ESG ESG 央企ESG 沪港深300 沪深港300 中证国资央企 企业核心竞争力 中证智选 中证民企 "
    "战略新兴成指 上证G60 富时中国A 富时中国国企 MSCI中国A 粤港澳大湾区"
).split()
INCOME = "红利 高股息 自由现金流 股东回报".split()
FOREIGN = (
    "港股 恒生 H股 中概 海外 全球 纳斯达克 标普 道琼斯 MSCI美国 日经 德国 法国 越南 印度 东南亚 沙特 巴西 DAX TOPIX "
    "富时亚太 新兴亚洲 韩国 香港"
).split()
HONG_KONG = "港股 恒生 H股 香港 沪港深 沪深港".split()
REGIONAL = (
    "中证浙江 中证福建 中证北京 长三角 京津冀 杭州湾 成渝 中关村 中证上海国企 上海改革发展 浙江国资 湖北新旧动能 "
    "张江自主创新 浙江凤凰行动"
).split()

LABELS = ["sw_l1_code", "sw_l1_name", "style_cap", "style_type", "sector_group"]


def _sector_rules() -> list[tuple[str, str, str]]:
    out = []
    for line in SECTORS.strip().splitlines():
        code, name, *words = line.split()
        out += [(w, code, name) for w in words]
    return out


def _group_of(sector: Column) -> Column:
    out = F.lit("")
    for line in GROUPS.strip().splitlines():
        group, *sectors = line.split()
        out = F.when(sector.isin(sectors), group).otherwise(out)
    return out


def index_name(name: Column) -> Column:
    """Fund name without product suffix, share class, remark and company name; NULL when nothing is left."""
    out = F.trim(name)
    for pattern in (r"(ETF|LOF|QDII)(\(QDII\))?$", r"[ABC]$", r"-.+$", "^(" + "|".join(COMPANIES) + ")"):
        out = F.regexp_replace(out, pattern, "")
    return F.nullif(F.trim(out), F.lit(""))


def fund_labels(index: Column) -> Column:
    """Struct of the five labels; rules are tried in the order sector, broad, income, foreign, regional.

    The name and the rule it meets are bound to variables: dozens of tests read them, and each would make them anew.
    """
    return _once(index, lambda name: _once(first_match(name, _sector_rules()), lambda hit: _labels(name, hit)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value made a single time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _labels(index: Column, hit: Column) -> Column:
    sector = hit["_3"]
    growth, value = F.contains(index, F.lit("成长")), F.contains(index, F.lit("价值"))
    own_style = F.when(sector.isin(DIVIDEND_SECTORS), "dividend").when(sector.isin(GROWTH_SECTORS), "growth").otherwise("blend")
    has = lambda *words: contains_any(index, words)
    broad_cap = (
        F.when(has("2000", "中创400"), "small").when(has("500", "800", "中小"), "mid").when(has("全指", "A股", "综指"), "all").otherwise("large")
    )
    broad_style = F.when(has(*INCOME), "dividend").when(value, "value").when(has("科创", "创业", "成长"), "growth").otherwise("blend")
    income_style = F.lit("dividend")
    place = F.when(has(*HONG_KONG), "港股").otherwise("跨境")

    def labels(*cols) -> Column:
        values = [c if isinstance(c, Column) else F.lit(c) for c in cols]
        return F.struct(*[v.alias(n) for v, n in zip(values, LABELS)])

    return (
        F.when(index.isNull() | (index == ""), labels("", "other", "unknown", "unknown", "other"))
        .when(
            hit.isNotNull(),
            labels(
                hit["_2"],
                sector,
                F.when(sector.isin(LARGE_SECTORS), "large").otherwise("mid"),
                F.when(growth, "growth").when(value, "value").otherwise(own_style),
                _group_of(sector),
            ),
        )
        .when(has(*BROAD), labels("", "", broad_cap, broad_style, ""))
        .when(has(*INCOME), labels("", "", "large", income_style, ""))
        .when(has(*FOREIGN), labels("", place, "large", "blend", place))
        .when(has(*REGIONAL), labels("", "区域主题", "mid", "blend", ""))
        .otherwise(labels("", "other", "unknown", "unknown", "other"))
    )
