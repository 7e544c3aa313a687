"""Repeatable catalogue generators (A8 basic, A9 word lists).

Rows come from a DataFrame of sequence numbers ``i`` (for example one per
input part row), so generation is as parallel as its input.  "Random"
columns are a hash of (seed, i, column), hence the same on every run and
under any partitioning: a task retried after an executor loss produces the
same rows.  Uniform picks use ``1 + pmod(hash, n)`` (every word equally likely
but for n / 2^32).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

# ---------------------------------------------------------------------------
# The application's generator word lists, in its order.
# ---------------------------------------------------------------------------
ADJECTIVES = ["Тайный", "Забытый", "Вечный", "Красный", "Цифровой", "Великий", "Железный",
              "Золотой", "Мертвый", "Тихий", "Безумный", "Ночной", "Солнечный"]
NOUNS = ["Код", "Император", "Лес", "Океан", "Сад", "Меч", "Дракон", "Программист", "Город",
         "Замок", "Человек", "Воин", "Ангел"]
SUFFIXES = ["Судьбы", "Времени", "Хаоса", "Теней", "Будущего", "Власти", "Смерти", "Жизни",
            "Света", "Тьмы", "Данных", "Java"]
FIRST_NAMES = ["Джон", "Мария", "Александр", "Елена", "Роберт", "Дэвид", "Анна", "Майкл",
               "Светлана", "Дмитрий"]
LAST_NAMES = ["Смит", "Джонсон", "Петров", "Иванов", "Кинг", "Роулинг", "Мартин", "Браун",
              "Уильямс", "Сидоров"]
CATEGORIES = ["Фантастика", "Классика", "Обучение", "Психология", "Бизнес", "История"]
IMAGE_URL_PREFIX = "https://dummyimage.com/400x600/000/fff&text="
BASIC_ISBN_PREFIX = "978-3-"
WORDS_ISBN_PREFIX = "978-0-"

HASH_BITS = 32


def hashed(i: Column, seed: int, salt: int) -> Column:
    """Whole number below 2^32 from (seed, i, salt): the first eight hex digits
    of an MD5, which other engines compute alike."""
    text = F.concat_ws(":", F.lit(str(seed)), i.cast("string"), F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def between(i: Column, seed: int, salt: int, lo: int, hi: int, scale: int = 1,
            nearest: bool = True) -> Column:
    """Uniform value in [lo, hi] in units of 1/scale, rounded to the nearest
    unit or cut down to one; whole-number arithmetic, hence exact."""
    exact = F.lit(lo * scale << HASH_BITS) + F.lit((hi - lo) * scale) * hashed(i, seed, salt)
    half = (1 << HASH_BITS - 1) if nearest else 0
    return F.shiftright(exact + F.lit(half), HASH_BITS)


def pick(words: list[str], i: Column, seed: int, salt: int) -> Column:
    k = F.pmod(hashed(i, seed, salt), F.lit(len(words))) + 1
    return F.element_at(F.array(*[F.lit(w) for w in words]), k.cast("int"))


def padded(i: Column, digits: int = 6) -> Column:
    """Zero-padded; numbers longer than the pad are kept whole."""
    t = i.cast("string")
    return F.lpad(t, F.greatest(F.lit(digits), F.length(t)), F.lit("0"))


def basic_catalog(ids: DataFrame, seed: int = 42, cut_isbn_digits: int | None = None) -> DataFrame:
    """Isbn '978-3-' + zero-padded i, 'Book Title i', 'Author i%100',
    'Category i%10', price 100–1000 (cents), stock 0–50, pages 100–1000.
    ``cut_isbn_digits=5`` gives the application's fixed width instead, where
    LPAD truncates and i = 10000 and 100000 collide."""
    i = F.col("i")
    pages = between(i, seed, 3, 100, 1000)
    number = padded(i) if cut_isbn_digits is None else F.lpad(i.cast("string"), cut_isbn_digits, "0")
    return ids.select(
        i.cast("long").alias("book_id"),
        F.concat(F.lit(BASIC_ISBN_PREFIX), number).alias("isbn"),
        F.concat(F.lit("Book Title "), i.cast("string")).alias("title"),
        F.concat(F.lit("Author "), (i % 100).cast("string")).alias("author"),
        (between(i, seed, 1, 100, 1000, scale=100).cast("decimal(12,0)") / 100).cast(S.PRICE).alias("price"),
        between(i, seed, 2, 0, 50).alias("stock"),
        F.concat(F.lit("Category "), (i % 10).cast("string")).alias("category"),
        F.concat(F.lit('{"pages": '), pages.cast("string"), F.lit(', "format":"paperback"}'))
         .alias("attributes_json"),
    )


def words_catalog(ids: DataFrame, seed: int = 42) -> DataFrame:
    """title = adjective noun suffix, author = first last name, one of six
    categories, isbn '978-0-' + 2-digit block (10–98) + '-' + padded i, price
    300–3000, stock 0–100, pages 100–900, discount 0–30 %, discounted price,
    image URL from the title."""
    i = F.col("i")
    title = F.concat_ws(" ", pick(ADJECTIVES, i, seed, 11), pick(NOUNS, i, seed, 12),
                        pick(SUFFIXES, i, seed, 13))
    author = F.concat_ws(" ", pick(FIRST_NAMES, i, seed, 14), pick(LAST_NAMES, i, seed, 15))
    block = between(i, seed, 16, 10, 99, nearest=False)   # TRUNC(VALUE(10,99)): 10..98
    price = between(i, seed, 17, 300, 3000).cast(S.PRICE)
    discount = between(i, seed, 20, 0, 30).cast(S.DISCOUNT)
    return ids.select(
        i.cast("long").alias("book_id"),
        F.concat(F.lit(WORDS_ISBN_PREFIX), F.lpad(block.cast("string"), 2, " "), F.lit("-"),
                 padded(i)).alias("isbn"),
        title.alias("title"), author.alias("author"), price.alias("price"),
        between(i, seed, 18, 0, 100).alias("stock"),
        pick(CATEGORIES, i, seed, 19).alias("category"),
        F.concat(F.lit('{"pages": '), between(i, seed, 21, 100, 900).cast("string"), F.lit("}")).alias("attributes_json"),
        F.concat(F.lit(IMAGE_URL_PREFIX), F.replace(title, F.lit(" "), F.lit("+"))).alias("image_url"),
        discount.alias("discount_percent"),
        (price * (F.lit(100) - discount) * F.lit(0.01).cast("decimal(2,2)")).cast(S.PRICE)
         .alias("price_after_discount"),
    )


def write_generated(df: DataFrame, path: str, partition_col: str = "category") -> None:
    """Publish a generated catalogue in one atomic job, laid out by category
    (the application committed every 5,000 rows; here each task commits its
    files and the job commits once)."""
    df.write.mode("errorifexists").partitionBy(partition_col).parquet(path)
