"""Seeds, province targets and finders (A-1, A-2, A-36, M-21). Finders take tables of requests: a lookup is a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators import merge
from siftwell.operators.joins import unique_lookup
from siftwell.operators.latest import first_by

#: Name, code, region, mode and the year it began.
PROVINCES = [
    ("北京", "11", "华北", "3+3", 2020), ("天津", "12", "华北", "3+3", 2020), ("河北", "13", "华北", "3+1+2", 2021), ("山西", "14", "华北", "传统文理", None),
    ("内蒙古", "15", "华北", "传统文理", None), ("辽宁", "21", "东北", "3+1+2", 2021), ("吉林", "22", "东北", "3+1+2", 2024), ("黑龙江", "23", "东北", "3+1+2", 2024),
    ("上海", "31", "华东", "3+3", 2017), ("江苏", "32", "华东", "3+1+2", 2021), ("浙江", "33", "华东", "3+3", 2017), ("安徽", "34", "华东", "3+1+2", 2024),
    ("福建", "35", "华东", "3+1+2", 2021), ("江西", "36", "华东", "3+1+2", 2024), ("山东", "37", "华东", "3+3", 2020), ("河南", "41", "华中", "传统文理", None),
    ("湖北", "42", "华中", "3+1+2", 2021), ("湖南", "43", "华中", "3+1+2", 2021), ("广东", "44", "华南", "3+1+2", 2021), ("广西", "45", "华南", "3+1+2", 2024),
    ("海南", "46", "华南", "3+3", 2020), ("重庆", "50", "西南", "3+1+2", 2021), ("四川", "51", "西南", "传统文理", None), ("贵州", "52", "西南", "3+1+2", 2024),
    ("云南", "53", "西南", "传统文理", None), ("西藏", "54", "西南", "传统文理", None), ("陕西", "61", "西北", "传统文理", None), ("甘肃", "62", "西北", "3+1+2", 2024),
    ("青海", "63", "西北", "传统文理", None), ("宁夏", "64", "西北", "传统文理", None), ("新疆", "65", "西北", "传统文理", None),
]
#: Subject categories by kind.
SUBJECTS = {
    "traditional": ["文科", "理科"],
    "new": ["物理类", "历史类", "综合改革", "综合"],
    "special": [
        "艺术类", "体育类", "艺术文", "艺术理", "体育文", "体育理", "蒙授理科", "蒙授文科", "汉授美术", "汉授音乐", "汉授编导", "汉授其他艺术", "汉授体育",
        "蒙授其他艺术", "蒙授体育", "蒙授音乐", "蒙授美术", "学考理", "学考文", "医学类", "计算机类", "农学类", "财会类", "化工类", "美工设计类", "牧医类", "采矿类",
        "幼师类", "蒙牧医类", "旅游类", "机电类", "建筑类", "汽驾类", "广播电视编导类", "舞蹈类", "美术类", "音乐类", "书法类", "农林类", "烹饪类", "畜牧兽医类", "单独考试招生",
    ],
}


def seeded(table: DataFrame, seeds: DataFrame) -> DataFrame:
    """A-2: seeds upserted by name; new ones get ids after the largest, in order of their names."""
    named = merge.register_members(table.select("id", "name"), seeds.select("name"), "id", "name")
    rows = seeds.join(named, "name").select([c for c in table.columns if c in ("id", *seeds.columns)])
    return merge.upsert(table, rows, merge.EntitySpec("seeds", ("name",), null_safe=False))


def province_seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROVINCES, "name string, code string, region string, exam_mode string, exam_mode_year int")


def subject_seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, kind) for kind, names in SUBJECTS.items() for n in names], "name string, category_type string")


def province_targets(provinces: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """A-36: id, name and url_value (the code, else the id), of all or of those named by either; blanks do not count."""
    targets = provinces.select("id", "name", F.coalesce(F.nullif("code", F.lit("")), F.col("id").cast("string")).alias("url_value"))
    given = [w.strip() for w in wanted or [] if w.strip()]
    return targets.filter(F.col("name").isin(given) | F.col("url_value").isin(given)) if given else targets


def by_name(rows: DataFrame, name: str, ident: str, external: str) -> DataFrame:
    """A-1, C-12: for each name the row with a positive external id first, then that of the smallest id."""
    return first_by(rows.filter(F.col(name).isNotNull()), [name], [F.col(external).__gt__(0).desc(), F.col(ident)])


def only_match(requests: DataFrame, key: Column, rows: DataFrame, by: str, ident: str, out: str) -> DataFrame:
    """A-1: for each request the id of the only row that has its key, else null."""
    found = unique_lookup(rows, by, ident, out)
    return requests.join(found, key == found["_key"], "left").drop("_key")


def school_major_ids(requests: DataFrame, school_majors: DataFrame, majors: DataFrame, fallback: bool = False) -> DataFrame:
    """M-21: requests (request, school_id, major_name, education_level, which may be null) with `major_id`: the only major of
    that name and level that the school has; with `fallback`, where it has none, the only one there is."""
    m = majors.select(F.col("id").alias("_id"), F.col("name").alias("_name"), F.col("education_level").alias("_level"))
    held = school_majors.select(F.col("school_id").alias("_school"), F.col("major_id").alias("_major")).distinct()

    def counted(found: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        """How many fit and the least id, by level and (the level null) over all levels: a row a lookup, however many fit."""
        sums = lambda df, n: df.agg(F.sum(n).alias(f"{prefix}n"), F.min("_id").alias("_id"))
        by_level = sums(found.dropna(subset=keys).groupBy(*keys, "_level"), F.lit(1))
        whole = sums(by_level.groupBy(*keys), f"{prefix}n").withColumn("_level", F.lit(None).cast(m.schema["_level"].dataType))
        return by_level.filter("_level IS NOT NULL").unionByName(whole).withColumnRenamed("_id", f"{prefix}id")

    def looked_up(rows: DataFrame, found: DataFrame, keys: dict[str, str], prefix: str) -> DataFrame:
        sums = counted(found, list(keys), prefix)
        on = reduce(lambda a, b: a & b, [rows[c] == sums[k] for k, c in keys.items()], rows["education_level"].eqNullSafe(sums["_level"]))
        return rows.join(sums, on, "left").drop("_level", *keys)

    offered = held.join(m, F.col("_major") == F.col("_id"))  # one hash join, then requests by school and name
    out = looked_up(requests, offered, {"_school": "school_id", "_name": "major_name"}, "_s")
    chosen = F.when(F.col("_sn") == 1, F.col("_sid"))
    if fallback:
        out = looked_up(out, m, {"_name": "major_name"}, "_g")
        chosen = chosen.when(F.col("_sn").isNull() & (F.col("_gn") == 1), F.col("_gid"))
    return out.select(*requests.columns, chosen.alias("major_id"))
