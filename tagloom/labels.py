"""Code books, ladders, patterns and solver settings.

Everything here is data that decides the text of a tag. All of it is a default:
every tag takes its book or ladder as an argument.
"""

from __future__ import annotations

from typing import NamedTuple


class Bin(NamedTuple):
    """One rung of a numeric ladder. Bounds left at None do not apply."""

    label: str | int
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    lt: float | None = None


class TextRule(NamedTuple):
    """One rung of a text ladder: any LIKE pattern or any exact text."""

    label: str
    like: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()


def scaled(bins: list[Bin], factor: float) -> list[Bin]:
    """The same ladder with every bound multiplied by ``factor``."""
    def times(bound):
        return None if bound is None else bound * factor
    return [Bin(b.label, times(b.ge), times(b.gt), times(b.le), times(b.lt)) for b in bins]


# ---- fixed values: code books -------------------------------------------------

UNKNOWN = "未知"

GENDER = {"1": "男", "2": "女"}
JOB = {"1": "学生", "2": "公务员", "3": "军人", "4": "警察", "5": "教师", "6": "白领"}
JOB_DEFAULT = "其他"
MARRIAGE = {"1": "未婚", "2": "已婚", "3": "离异"}
NATIONALITY = {"1": "中国大陆", "2": "中国香港", "3": "中国澳门", "4": "中国台湾", "5": "其他"}
POLITICAL_FACE = {"1": "群众", "2": "党员", "3": "无党派人士"}

HOME_CITY = {
    "716": "北京市",
    "173": "山东青岛",
    "335": "甘肃兰州",
    "23": "werwer",
    "361": "宁夏中卫",
    "172": "山东济南",
    "135": "安徽合肥",
    "175": "江西抚州",
    "271": "重庆市",
    "338": "甘肃白银",
    "42": "河北保定",
    "152": "福建福州",
    "237": "广东韶关",
    "154": "福建莆田",
    "115": "江苏苏州",
    "155": "福建三明",
    "161": "江西南昌",
    "236": "广东汕头",
    "107": "黑龙江黑河",
    "109": "黑龙江大兴安岭",
    "98": "黑龙江齐齐哈尔",
    "67": "内蒙古鄂尔多斯",
    "108": "黑龙江绥化",
    "62": "内蒙古呼和浩特",
}
HOME_CITY_DEFAULT = "null"

BRAND_GROUP = {"1": ("297", "301", "0"), "2": ("298",), "3": ("299",), "4": ("303", "5"), "5": ("305",)}
BRAND_GROUP_DEFAULT = "0"
BRAND_NAME = {"1": "海尔", "2": "卡萨帝", "3": "统帅", "4": "小超人", "5": "摩卡"}
BRAND_NAME_DEFAULT = "其他"

# Cluster number -> value label, bound to the stored model it was named for.
USER_VALUE = {
    "0": "中频率高消费",
    "1": "中频率较高消费",
    "2": "低频率中消费",
    "3": "高频率高消费",
    "4": "低频率高消费",
    "5": "低频率低消费",
    "6": "较低频率较高消费",
}

# ---- fixed values: ladders (first match wins) -----------------------------------

AGE_RANGE = [
    Bin("50后", ge=1950, lt=1960),
    Bin("60后", ge=1960, lt=1970),
    Bin("70后", ge=1970, lt=1980),
    Bin("80后", ge=1980, lt=1990),
    Bin("90后", ge=1990, lt=2000),
    Bin("00后", ge=2000, lt=2010),
    Bin("10后", ge=2010, lt=2020),
    Bin("20后", ge=2020, lt=2030),
]

# month * 100 + day
CONSTELLATION = [
    Bin("白羊座", ge=321, le=420),
    Bin("金牛座", ge=421, le=520),
    Bin("双子座", ge=521, le=621),
    Bin("巨蟹座", ge=622, le=723),
    Bin("狮子座", ge=724, le=823),
    Bin("处女座", ge=824, le=923),
    Bin("天秤座", ge=924, le=1023),
    Bin("天蝎座", ge=1024, le=1122),
    Bin("人马座", ge=1123, le=1221),
    Bin("摩羯座", ge=1222, le=1231),
    Bin("摩羯座", ge=101, le=120),
    Bin("水瓶座", ge=121, le=219),
    Bin("双鱼座", ge=220, le=320),
]

# days before the reference date
LATEST_LOGIN = [
    Bin("1天内", gt=0, le=1),
    Bin("7天内", gt=1, le=7),
    Bin("14天内", gt=7, le=14),
    Bin("30天内", gt=14, le=30),
]
LATEST_LOGIN_DEFAULT = "超过30天未登录"

RFM_RECENCY = [Bin(5, ge=1, le=3), Bin(4, ge=4, le=6), Bin(3, ge=7, le=9), Bin(2, ge=10, le=15), Bin(1, ge=16)]
RFM_FREQUENCY = [Bin(5, ge=200), Bin(4, ge=150, le=199), Bin(3, ge=100, le=149), Bin(2, ge=50, le=99), Bin(1, ge=1, le=49)]
RFM_MONEY = [
    Bin(5, ge=200000),
    Bin(4, ge=100000, le=199999),
    Bin(3, ge=50000, le=99999),
    Bin(2, ge=10000, le=49999),
    Bin(1, le=9999),
]

SPEND_TOTAL = [
    Bin("超高", ge=1000000),
    Bin("高", ge=800000),
    Bin("中上", ge=600000),
    Bin("中", ge=400000),
    Bin("中下", ge=200000),
    Bin("低", ge=100000),
    Bin("很低", lt=100000),
]

# The gaps (49999, 29999, 9999 and the like) are part of the definition.
SPEND_MAX = [
    Bin(">50000", ge=50000),
    Bin("30000-49999", ge=30000, lt=49999),
    Bin("10000-29999", ge=10000, lt=29999),
    Bin("1-9999", lt=9999),
]
SPEND_AVG = [
    Bin(">5000", ge=5000),
    Bin("3000-4999", ge=3000, lt=4999),
    Bin("1000-2999", ge=1000, lt=2999),
    Bin("1-999", lt=999),
]

PURCHASE_FREQUENCY = [Bin("高", ge=400), Bin("中", ge=200, lt=400), Bin("低", ge=0, lt=200)]
ADVISORY = [Bin("高", ge=0.3), Bin("中", ge=0.1, lt=0.3), Bin("低", lt=0.1)]
CONSUMPTION_CYCLE = [
    Bin("6月", ge=150),
    Bin("5月", ge=120, lt=150),
    Bin("4月", ge=90, lt=120),
    Bin("3月", ge=60, lt=90),
    Bin("2月", ge=30, lt=60),
    Bin("1月", ge=14, lt=30),
    Bin("2周", ge=7, lt=14),
    Bin("7日", lt=7),
]
REPLACEMENT = [Bin("中", ge=0.0001, lt=0.3), Bin("低", lt=0.0001), Bin("高", ge=0.3)]
RETURN = [Bin("高", ge=0.01), Bin("中", ge=0.005, lt=0.01), Bin("低", ge=0, lt=0.005)]

DISCOUNT = [Bin("8折-9折", ge=0.8, le=1), Bin("5折-7折", ge=0.5, lt=0.8), Bin("3折-4折", ge=0.3, lt=0.5)]
PRICE_SENSITIVITY = [
    Bin("极度敏感", ge=1),
    Bin("比较敏感", ge=0.6, lt=1),
    Bin("一般敏感", ge=0.3, lt=0.6),
    Bin("不太敏感", ge=0, lt=0.3),
    Bin("极度不敏感", lt=0),
]
NO_COUPON = "0.00"

# Frequency against the population average a, for a count c.
FREQUENCY_NONE, FREQUENCY_LOW, FREQUENCY_MID, FREQUENCY_HIGH = "无", "较少", "一般", "经常"
LOGIN_LOW_FACTOR = 1.8
VIEW_LOW_FACTOR = 4.0
FREQUENCY_HIGH_DIVISOR = 1.2

# hour of day -> reading period; every other hour, and no hour, is the default
READ_PERIOD = [
    Bin("1点-7点", ge=1, le=7),
    Bin("8点-12点", ge=8, le=12),
    Bin("13点-17点", ge=13, le=17),
    Bin("18点-21点", ge=18, le=21),
]
READ_PERIOD_DEFAULT = "22点-24点"

WATCH_UNDER_ONE, WATCH_ONE_TO_FIVE, WATCH_OVER_FIVE = "1分钟内", "1-5分钟", "5分钟以上"

# ---- fixed values: text ladders (first match wins) --------------------------------

DEVICE = [
    TextRule("Windows", like=("%Windows%",)),
    TextRule("Mac", like=("%Mac OS%",)),
    TextRule("Android", like=("%Android%",)),
    TextRule("IOS", like=("%CPU iPhone OS%",)),
]
DEVICE_DEFAULT = "Linux"

PAGE_TYPE = [
    TextRule("登录页", like=("%login%",)),
    TextRule("首页", like=("%index%",), equals=("http://www.eshop.com/", "http://m.eshop.com/")),
    TextRule("分类页", like=("%/c/%",)),
    TextRule("商品页", like=("%/product/%",)),
    TextRule("我的订单页", like=("%order%",)),
]
PAGE_TYPE_DEFAULT = "其他"

LOGIN_PATTERN = "%login%"
PRODUCT_START, PRODUCT_END = "/product/", ".html"

# ---- fixed values: solver settings ------------------------------------------------

ALS_PAGE_VIEWS = {"rank": 5, "maxIter": 5, "regParam": 0.01, "alpha": 10.0}
ALS_FAVOURITES = {"rank": 10, "maxIter": 10, "regParam": 1.0, "alpha": 10.0}
ALS_USER_BLOCKS, ALS_ITEM_BLOCKS = 16, 8  # at least; raise with the cluster, their product is what a task buffers
ALS_BLOCK_ROWS = 1 << 21  # ratings of a block, about: a task holds them with the factors of the other side
MOST_NUMBER = 2**31 - 1  # ALS numbers users and items by ints
TOP_PRODUCTS, TOP_TYPES, TOP_BRANDS = 10, 5, 4
RFM_KMEANS = {"k": 7, "seed": 100, "maxIter": 2}

# ---- fixed values: profile layout --------------------------------------------------

RANK_COLUMNS = [f"productName{k}" for k in range(9)]

# The console view of the profile.
PROFILE_VIEW = [
    "num", "gender", "jiguan", "job", "nationality", "politicalFace", "paymentCode", "ageRange",
    "constellation", "ComsumptionAbility", "MaxSingleComsumption", "PerCustomerTransation",
    "purchaseFrequency", "device", "userValue", "favorProducts", "discount", "favorProductsType",
    "PriceSensitivity", "favorBrandName", "browser_loc_url", *RANK_COLUMNS, "LoginFrequency",
    "ViewFrequency",
]

# The relational export of the profile.
PROFILE_EXPORT = [
    "gender", "nationality", "politicalFace", "paymentCode", "ageRange", "constellation", "LatestLogin",
]
