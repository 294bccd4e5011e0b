"""Favourites by implicit-feedback matrix factorisation (Spark ML's ALS)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom import labels as L
from tagloom.functions.casting import whole_id
from tagloom.functions.ladders import decode, decode_many
from tagloom.operators.grouping import set_join
from tagloom.operators.inner_product import best_lists, ranked
from tagloom.operators.joining import lookup, order_lines
from tagloom.operators.numbering import numbered_ids
from tagloom.operators.ranking import ranks_to_columns
from tagloom.operators.staging import stage
from tagloom.plans.log_tags import viewed_products
from tagloom.session import use_checkpoints
from tagloom.sources.tables import Sources


# ---- ratings ---------------------------------------------------------------------

def _rating(pairs: DataFrame, item: str) -> DataFrame:
    """Rows, or already counted ``rows``, per user and item."""
    counted = "rows" if "rows" in pairs.columns else "1"
    whole = pairs.selectExpr(f"{whole_id('id')} AS userId", f"{whole_id(item)} AS {item}", f"CAST({counted} AS BIGINT) AS rows")
    known = whole.where(f"userId IS NOT NULL AND {item} IS NOT NULL")
    return known.groupBy("userId", item).agg(F.sum("rows").alias("rating"))


def view_ratings(logs: DataFrame) -> DataFrame:
    """Page views per visitor and product."""
    return _rating(viewed_products(logs), "productId")


def bought_items(orders: DataFrame, goods: DataFrame, id_digits: int | None,
                 groups: dict = L.BRAND_GROUP) -> DataFrame:
    """(id, productId, brand group) of every order line."""
    return items_of_lines(order_lines(orders, goods, id_digits), groups)


def items_of_lines(lines: DataFrame, groups: dict = L.BRAND_GROUP) -> DataFrame:
    brand = decode_many("brandId", groups, L.BRAND_GROUP_DEFAULT)
    return lines.selectExpr("id", "productId", f"{brand} AS brand")


def counted_items(items: DataFrame) -> DataFrame:
    """Bought items with their number of lines: what both order models need of the join."""
    return items.groupBy("id", "productId", "brand").agg(F.count(F.lit(1)).alias("rows"))


def order_ratings(items: DataFrame) -> DataFrame:
    """Order lines per customer and product, from bought items, counted or not."""
    return _rating(items, "productId")


def brand_ratings(items: DataFrame) -> DataFrame:
    """Order lines per customer and brand group, from bought items, counted or not."""
    return _rating(items, "brand")


def product_dimension(goods: DataFrame) -> DataFrame:
    """One row per product that was ever sold: (productId, productName, productType, lines), from one pass
    over the order lines. Ids have the spelling of ratings: 007 is 7. Of several names the smallest counts.

    Equal lines are counted before a product's lines come together, so a hot product arrives as its
    few different names. Staged: all favourites read this one table, and both sides of a join with it
    have an exchange of their own, so that a hot product can be split.
    """
    names = [c for c in ("productName", "productType") if c in goods.columns]
    known = goods.selectExpr(f"{whole_id('productId')} AS productId", *names).where("productId IS NOT NULL")
    counted = known.groupBy("productId", *names).agg(F.count(F.lit(1)).alias("lines"))
    smallest = [F.min(F.struct(name))[name].alias(name) for name in names]
    return stage(counted.groupBy("productId").agg(*smallest, F.sum("lines").alias("lines")), "products")


def with_line_copies(ratings: DataFrame, products: DataFrame) -> DataFrame:
    """Ratings of products that were ever sold, with the product's number of order lines; from the
    order lines, or from their ``product_dimension`` where there is one.

    This is the join of ratings and order lines kept in compact form: each joined row
    would only repeat the rating, so the rating is kept once with its number of copies.
    A product with many viewers and many lines stays as small as its viewers.
    """
    lines = _dimension(products).select("productId", F.col("lines").alias("copies"))
    return ratings.join(lines, "productId", "inner").select("userId", "productId", "rating", "copies")


def _dimension(products: DataFrame) -> DataFrame:
    return products if "lines" in products.columns else product_dimension(products)


def copies_as_confidence(ratings: DataFrame) -> DataFrame:
    """Rating times copies: the confidence that repeated rows would add up to.

    Implicit ALS weighs an observation by 1 + alpha * rating; n equal rows and one row of
    n times the rating put the same alpha-weight on the pair.
    """
    return ratings.select("userId", "productId", (F.col("rating") * F.col("copies")).alias("rating"))


# ---- models ----------------------------------------------------------------------

@dataclass(frozen=True)
class Favourites:
    """A fitted model with the dense numbers that stand for its users and items in it."""

    model: ALSModel
    item: str
    users: DataFrame
    items: DataFrame

    def user_factors(self) -> DataFrame:
        factors = self.model.userFactors.withColumnRenamed("id", "number")
        return factors.join(self.users, "number").select(F.col("userId").alias("id"), "features")

    def item_factors(self) -> DataFrame:
        factors = self.model.itemFactors.withColumnRenamed("id", "number")
        return factors.join(self.items, "number").select(F.col(self.item).alias("item"), "features")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.items.write.mode("overwrite").parquet(f"{path}/items")

    @classmethod
    def load(cls, spark: SparkSession, path: str, item: str) -> Favourites:
        users, items = (spark.read.parquet(f"{path}/{side}") for side in ("users", "items"))
        return cls(ALSModel.load(f"{path}/model"), item, users, items)


def dense_numbers(ratings: DataFrame, column: str) -> DataFrame:
    """(column, number): a dense int for every id, which is all that Spark ML's ALS takes."""
    index = numbered_ids(ratings.select(column))
    different = index.count()
    if different > L.MOST_NUMBER + 1:
        raise ValueError(f"{different} different values of {column}: ALS can tell {L.MOST_NUMBER + 1} apart")
    return index.select(column, F.col("number").cast("int").alias("number"))


def fit_als(ratings: DataFrame, item: str, settings: dict, seed: int = 42,
            user_blocks: int = L.ALS_USER_BLOCKS, item_blocks: int = L.ALS_ITEM_BLOCKS) -> Favourites:
    """Implicit ALS over ids of any width. Every rating task keeps user blocks times item blocks
    buffers, so neither follows the shuffle width. A task solves a whole block, so there are as many
    blocks as the ratings need; where that is more than asked for, a rating task has no more rows than
    a block, and the shuffle files of an iteration go with it. Long lineage is checkpointed."""
    use_checkpoints(ratings.sparkSession)
    rated = stage(ratings, "ratings")
    users, items = dense_numbers(rated, "userId"), dense_numbers(rated, item)
    dense = rated.join(users.withColumnRenamed("number", "user"), "userId").join(items.withColumnRenamed("number", "item"), item).select("user", "item", "rating")
    needed = needed_blocks(rated.count())
    many = needed > min(user_blocks, item_blocks)
    solver = ALS(userCol="user", itemCol="item", ratingCol="rating", implicitPrefs=True, coldStartStrategy="drop", seed=seed,
                 numUserBlocks=max(user_blocks, needed), numItemBlocks=max(item_blocks, needed), checkpointInterval=1 if many else 10, **settings)
    return Favourites(solver.fit(dense.repartition(needed, "user", "item") if many else dense), item, users, items)


def needed_blocks(ratings: int) -> int:
    """Blocks of at most about ``ALS_BLOCK_ROWS`` ratings each."""
    return -(-ratings // L.ALS_BLOCK_ROWS)


def fit_page_views(ratings: DataFrame, products: DataFrame, seed: int = 42, weigh=copies_as_confidence) -> Favourites:
    """The model behind the ranked product names, from view ratings."""
    return fit_als(weigh(with_line_copies(ratings, products)), "productId", L.ALS_PAGE_VIEWS, seed)


def top_lists(fitted: Favourites, n: int, users: DataFrame | None = None) -> DataFrame:
    """(id, items, scores, scored) per user; with ``users`` (userId) only for those users. ``scored``
    items of the catalogue were looked at: the others cannot be among the n best."""
    factors = fitted.user_factors()
    if users is not None:
        factors = factors.join(users.select(F.col("userId").alias("id")).distinct(), "id", "left_semi")
    return best_lists(factors, fitted.item_factors(), n)


def top_items(fitted: Favourites, n: int, users: DataFrame | None = None) -> DataFrame:
    """(id, rank, item) of the n best items per user; equal scores go to the smaller item."""
    best = ranked(top_lists(fitted, n, users), fitted.item)
    return best.select("id", "rank", F.col(fitted.item).cast("string").alias(fitted.item))


# ---- tags ------------------------------------------------------------------------

def catalogue(products: DataFrame, name: str = "productName") -> DataFrame:
    """(productId, name) for lookups by the text that ranked items have."""
    return _dimension(products).select(F.col("productId").cast("string").alias("productId"), name)


def favourite_sets(top: DataFrame, products: DataFrame, attribute: str, name: str) -> DataFrame:
    """Product attributes of the top items as one sorted list per user."""
    named = lookup(top, "productId", catalogue(products, attribute), "productId")
    return set_join(named, "id", attribute, name)


def favourite_products(ratings: DataFrame, products: DataFrame, seed: int = 42) -> DataFrame:
    """From view ratings; ``products`` are order lines or their dimension."""
    model = fit_als(ratings, "productId", L.ALS_FAVOURITES, seed)
    return favourite_sets(top_items(model, L.TOP_PRODUCTS), products, "productName", "favorProducts")


def favourite_types(items: DataFrame, products: DataFrame, seed: int = 42) -> DataFrame:
    """From bought items."""
    model = fit_als(order_ratings(items), "productId", L.ALS_FAVOURITES, seed)
    return favourite_sets(top_items(model, L.TOP_TYPES), products, "productType", "favorProductsType")


def brand_sets(brands: DataFrame, name: str = "favorBrandName", book: dict = L.BRAND_NAME) -> DataFrame:
    """Brand names of (id, brand) rows as one sorted list per user."""
    named = brands.selectExpr("id", f"{decode('CAST(brand AS STRING)', book, L.BRAND_NAME_DEFAULT)} AS brandName")
    return set_join(named, "id", "brandName", name)


def favourite_brands(items: DataFrame, seed: int = 42) -> DataFrame:
    """From bought items."""
    model = fit_als(brand_ratings(items), "brand", L.ALS_FAVOURITES, seed, item_blocks=1)  # six brand groups
    return brand_sets(top_items(model, L.TOP_BRANDS))


def names_by_rank(top: DataFrame, products: DataFrame, names: list[str] = L.RANK_COLUMNS) -> DataFrame:
    """Product names of the ranked items, one column per rank: one join for all ranks."""
    wanted = top.where(F.col("rank") < len(names))
    named = lookup(wanted, "productId", catalogue(products), "productId")
    return ranks_to_columns(named, "id", "rank", "productName", names)


def page_view_favourites(model: Favourites, products: DataFrame) -> DataFrame:
    return names_by_rank(top_items(model, len(L.RANK_COLUMNS)), products)


def favourite_frames(sources: Sources, id_digits: int | None, stage=None, seed: int = 42) -> list[DataFrame]:
    """All favourites, by id. ``stage`` stores what two models share, so that the log and the
    order-line join are read once."""
    keep = stage or (lambda df: df)
    views = keep(view_ratings(sources.logs))
    items = keep(counted_items(items_of_lines(sources.order_lines(id_digits))))
    products = product_dimension(sources.goods)
    return [
        favourite_products(views, products, seed),
        favourite_types(items, products, seed),
        favourite_brands(items, seed),
        page_view_favourites(fit_page_views(views, products, seed), products),
    ]
