"""Image inventory, naming and assignment of pictures to colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions import text as T
from vitrine.functions.colors import cluster_score, color_name, is_background, neighbours
from vitrine.operators.scale import number_within, rows_if_small, slices_and_rows, top_n_by_key

# What separates a product key from its picture letters in a file stem.
KEY_AND_LETTER = r"^([A-Za-z]?[0-9]+)([a-z]+)"


def with_key(files: DataFrame, path: str = "path", key: str = "product_no") -> DataFrame:
    """Files whose stem starts with a number, and that number."""
    # Bound once: the rules look at path and stem several times, and the filter at their result.
    named = T.let(path, lambda p: T.let(T.file_stem(p), lambda s: F.struct(s.alias("stem"), T.number_key(s).alias("key"))))
    return (files.withColumn("__named", named).withColumn("stem", F.col("__named.stem"))
            .withColumn(key, F.col("__named.key")).drop("__named").filter(F.col(key).isNotNull()))


def rename_plan(files: DataFrame, scope: DataFrame | None = None, color: str | None = None,
                slice_by: Column | None = None) -> DataFrame:
    """New name and size class of every image (path, width, height, ord).

    Square pictures come first, then input order; the position becomes the
    letter.  Positions are counted per (product, slice of ``ord``), so one
    product with very many pictures is spread over many tasks.
    """
    keyed = with_key(files)
    if scope is not None:
        wanted = scope.select(T.number_key("sku").alias("product_no")).distinct()
        keyed = keyed.join(wanted, "product_no", "left_semi")
    square = F.coalesce(F.col("width") == F.col("height"), F.lit(False))
    keyed = keyed.withColumn("not_square", (~square).cast("int"))
    # The cuts only have to be even roughly; the bare order column is enough.
    slices, rows = slices_and_rows(files, "ord") if slice_by is None else (slice_by, None)
    numbered = number_within(keyed.select("path", "product_no", "not_square", "ord"), ["product_no"], ["not_square", "ord"],
                             F.struct("not_square", slices.alias("s")), "position", rows)
    letter = T.letter_for_index(F.col("position") - 1)
    tail = F.concat(F.lit("_"), F.coalesce(F.nullif(color, F.lit("")), F.lit("unknown"))) \
        if color else F.lit("")
    return numbered.select(
        "path", "product_no", "position", letter.alias("letter"),
        F.concat("product_no", letter, tail, F.lit(".webp")).alias("new_name"),
        F.when(letter == "a", V.MAIN_IMAGE_KB).otherwise(V.GALLERY_IMAGE_KB).alias("limit_kb"))


def dominant_color(clusters: DataFrame, image: str = "image", min_share: float = 0.05) -> DataFrame:
    """Best pixel cluster of every image and its colour name.

    Rows are (image, r, g, b, share, dark_product); background clusters and
    clusters of 5 % or less cannot win, the larger cluster wins a tie.
    """
    scored = clusters.filter(~is_background("r", "g", "b") & (F.col("share") > min_share)) \
        .withColumn("score", cluster_score("r", "g", "b", "share", F.col("dark_product")))
    order = [F.col("score").desc(), F.col("share").desc(), "r", "g", "b"]
    best = top_n_by_key(scored, image, order, 1)
    return best.select(image, "r", "g", "b", color_name("r", "g", "b").alias("color"))


# ---- assignment of pictures to colours ----------------------------------------

def pictures_by_product(files: DataFrame, pattern: str = KEY_AND_LETTER) -> DataFrame:
    """All pictures of a product, by the length of their letters, letters and path.

    The first file of a letter goes by key and letter, the others by their
    stems.  A file listed twice is one file; it is folded on the map side.
    """
    stem = T.file_stem("path")
    keyed = (files.select("path", stem.alias("stem"))
             .select("path", "stem", F.regexp_extract("stem", pattern, 1).alias("image_key"),
                     F.regexp_extract("stem", pattern, 2).alias("letter"))
             .filter("image_key <> ''"))
    picture = F.struct(F.length("letter").alias("n"), "letter", "path", "stem")
    ordered = F.sort_array(F.collect_set(picture))

    def named(pics):
        return F.transform(pics, lambda p, i: F.struct(
            F.when((i > 0) & (F.get(pics, i - 1)["letter"] == p["letter"]), p["stem"])
            .otherwise(F.concat("image_key", p["letter"])).alias("source"),
            T.filename_tail(p["stem"]).alias("tail")))
    return keyed.groupBy("image_key").agg(ordered.alias("listed")).select(
        "image_key", named(F.col("listed")).alias("pictures"))


def match_colors(pictures: Column, colors: Column) -> Column:
    """Greedy match of colours, in order, to unused pictures.

    Picture 0 is reserved.  A colour takes the first picture whose name holds
    it (or is held by it), else one naming one of its words, else one naming a
    similar colour.  The result lists (color, norm, index, kind).
    """
    hit_type = "struct<color:string,norm:string,index:int,kind:string>"
    # Pictures of one tail are taken in order, so a colour only looks at distinct tails
    # and finds the first picture left of each; a taken picture becomes NULL.
    left = F.transform(pictures, lambda p, i: F.when(i > 0, p["tail"]))
    state = F.struct(F.array().cast(f"array<{hit_type}>").alias("hits"), left.alias("left"))
    tails = F.transform(F.filter(F.array_distinct(left), lambda t: t.isNotNull()), lambda t: F.struct(
        t.alias("tail"), F.lower(T.trim_any(t)).alias("low")))

    def rank(left, tails, c):
        def of_tail(t):
            tail, low = t["tail"], t["low"]
            # What is_similar tests, with the neighbours of the colour looked up once.
            similar = (c["low"].contains(low) | low.contains(c["low"])
                       | F.coalesce(F.array_contains(c["near"], low), F.lit(False)))
            step = (F.when(tail.contains(c["norm"]) | c["norm"].contains(tail), 1)
                    .when(F.exists(c["words"], lambda w: tail.contains(w)), 2)
                    .when(similar, 3))
            return T.let(F.array_position(left, tail), lambda at: F.when(at > 0, T.let(step, lambda s: F.when(
                s.isNotNull(), F.struct(s.alias("step"), (at - 1).alias("index"), (tail == "").alias("blank"))))))
        return F.array_min(F.filter(F.transform(tails, of_tail), lambda x: x.isNotNull()))

    def taken(at, color, c, best):
        kind = (F.when(best["blank"] & (best["step"] == 1), "blank").when(best["step"] == 1, "exact")
                .when(best["step"] == 2, "word").otherwise("similar"))
        hit = F.struct(color.alias("color"), c["norm"].alias("norm"),
                       best["index"].cast("int").alias("index"), kind.alias("kind"))
        i = best["index"].cast("int")
        left = F.concat(F.slice(at["left"], F.lit(1), i), F.array(F.lit(None).cast("string")),
                        F.slice(at["left"], i + 2, F.size(at["left"])))
        return F.when(best.isNotNull(), F.struct(F.concat(at["hits"], F.array(hit)).alias("hits"),
                                                 left.alias("left"))).otherwise(at)

    def attempt(at, color, tails):
        return T.let(T.dash_slug(color), lambda norm: F.when(norm == "", at).otherwise(T.let(
            F.struct(norm.alias("norm"), F.filter(F.split(norm, "[-_ ]+"), lambda w: w != "").alias("words"),
                     F.lower(T.trim_any(norm)).alias("low"), neighbours(F.lower(T.trim_any(norm))).alias("near")),
            lambda c: T.let(rank(at["left"], tails, c), lambda best: taken(at, color, c, best)))))

    return T.let(tails, lambda known: F.aggregate(
        colors, state, lambda at, color: attempt(at, color, known), lambda at: at["hits"]))


def assign_images(products: DataFrame, files: DataFrame, extension: str = ".webp",
                  pattern: str = KEY_AND_LETTER) -> DataFrame:
    """Picture names of every product (sku, name_fa, name_en, model, colors).

    Adds main_image, color_images, general_images, gallery (file and alt
    text), mapping (source to new name) and matches.  A product without
    pictures gets names made from its colours and an empty mapping.
    """
    pics = pictures_by_product(files, pattern)
    no_pictures = F.array().cast("array<struct<source:string,tail:string>>")
    seen = F.coalesce("pictures", no_pictures)
    spelled = F.transform("colors", lambda c: F.struct(T.dash_slug(c).alias("norm"), c.alias("color")))
    joined = products.join(pics, F.col("sku") == F.col("image_key"), "left")
    # The match is a column of its own and so is every name: what nobody asks for is not made.
    matched = joined.withColumn("__seen", seen).withColumn("__hits", match_colors(F.col("__seen"), F.col("colors")))
    base = F.concat_ws("-", "name_en", T.model_slug("model"))
    known = F.struct(
        F.col("__seen").alias("pictures"), F.col("__hits").alias("hits"), spelled.alias("spelled"), base.alias("base"),
        F.concat_ws(" ", "name_fa", F.lit(V.CODE_WORD), "model").alias("title"))

    def made(name):
        return T.let(known, lambda v: _names_of(v, extension, name)).alias(name)
    return matched.select(
        *products.columns, F.concat(base, F.lit("-main" + extension)).alias("main_image"),
        *[made(n) for n in ("color_images", "general_images", "gallery", "mapping", "matches")])


def _names_of(v: Column, extension: str, name: str) -> Column:
    """One kind of picture names of a product from its pictures, colours and matches."""
    have = F.size(v["pictures"]) > 0
    title = v["title"]

    def file(tail):
        return F.concat(v["base"], F.lit("-"), tail, F.lit(extension))

    def source(i):
        return F.get(v["pictures"], i)["source"]

    spelled_norms = F.transform(v["spelled"], lambda s: s["norm"])
    wanted = F.when(have, F.transform(v["hits"], lambda h: h["norm"])).otherwise(
        F.filter(spelled_norms, lambda n: n != ""))
    used = F.transform(v["hits"], lambda h: h["index"])
    rest = T.let(used, lambda taken: F.filter(F.sequence(F.lit(0), F.size(v["pictures"])), lambda i: (
        (i > 0) & (i < F.size(v["pictures"])) & ~F.array_contains(taken, i))))
    # The first colour whose name ends the file name gives the alt text; a
    # colour written twice is shown in its last spelling.
    shown = F.transform(F.array_distinct(spelled_norms), lambda n: F.struct(
        F.concat(F.lit("-"), n, F.lit(extension)).alias("ending"),
        F.element_at(F.filter(v["spelled"], lambda s: s["norm"] == n), -1)["color"].alias("color")))
    number_pattern = r"-([0-9]+)" + extension.replace(".", r"\.") + "$"

    def alt(name, colors):
        color = F.get(F.filter(colors, lambda s: name.endswith(s["ending"])), F.lit(0))["color"]
        plain = T.let(T.found(name, number_pattern), lambda no: F.when(
            no.isNotNull(), F.concat(title, F.lit(V.ALT_VIEW), no)).otherwise(title))
        return F.when(name.contains("-main"), title).otherwise(T.let(color, lambda c: F.when(
            c.isNotNull(), F.concat(title, F.lit(V.ALT_COLOR), c)).otherwise(plain)))

    main = file(F.lit("main"))
    norms = F.array_distinct(wanted)

    def numbered(rest):
        return F.transform(rest, lambda i, k: file(F.lpad((k + 1).cast("string"), 2, "0")))

    def gallery():
        everything = F.concat(F.array(main), F.transform(norms, file), numbered(rest))
        named = T.let(shown, lambda colors: F.transform(everything, lambda x: F.struct(
            x.alias("file"), alt(x, colors).alias("alt"))))
        made_up = F.concat(
            F.array(F.struct(main.alias("file"), title.alias("alt"))),
            F.transform(F.filter(v["spelled"], lambda s: s["norm"] != ""), lambda s: F.struct(
                file(s["norm"]).alias("file"), F.concat(title, F.lit(V.ALT_COLOR), s["color"]).alias("alt"))))
        return F.when(have, named).otherwise(made_up)

    def mapping():
        pairs = F.concat(
            F.array(F.struct(source(F.lit(0)).alias("source"), main.alias("target"))),
            F.transform(v["hits"], lambda h: F.struct(source(h["index"]).alias("source"),
                                                      file(h["norm"]).alias("target"))),
            F.transform(rest, lambda i, k: F.struct(
                source(i).alias("source"), file(F.lpad((k + 1).cast("string"), 2, "0")).alias("target"))))
        return F.when(have, pairs).otherwise(F.array().cast("array<struct<source:string,target:string>>"))

    def matches():
        return F.transform(v["hits"], lambda h: F.struct(
            h["color"].alias("color"), source(h["index"]).alias("source"), h["kind"].alias("kind")))

    kinds = {"color_images": lambda: F.transform(norms, lambda x: F.struct(x.alias("norm"), file(x).alias("file"))),
             "general_images": lambda: numbered(rest), "gallery": gallery, "mapping": mapping, "matches": matches}
    return kinds[name]()


def variant_images(colors: Column, color_images: Column, general: Column, main: Column,
                   use_general: bool = True) -> Column:
    """Picture of every variant colour, in order.

    Exact colour picture, then one whose colour holds or is held by it.  The
    k-th variant left over takes the k-th general picture, later ones the main
    picture.
    """
    def own(color):
        def first(test):
            return F.get(F.filter(color_images, test), F.lit(0))["file"]

        return T.let(T.dash_slug(color), lambda norm: F.coalesce(
            first(lambda p: p["norm"] == norm), first(lambda p: p["norm"] == color),
            first(lambda p: p["norm"].contains(norm) | norm.contains(p["norm"]))))

    owned = F.transform(colors, own)
    if not use_general:
        return F.transform(owned, lambda f: F.coalesce(f, main))

    def placed(mine):
        left_over = F.filter(F.transform(mine, lambda f, i: F.when(f.isNull(), i)),
                             lambda i: i.isNotNull())
        return T.let(left_over, lambda rest: F.transform(mine, lambda f, i: F.coalesce(
            f, F.get(general, F.array_position(rest, i).cast("int") - 1), main)))
    return T.let(owned, placed)


# ---- source files, folders, sizes ---------------------------------------------

def find_sources(mapping: DataFrame, files: DataFrame) -> DataFrame:
    """File of every (source, target): its exact stem, else ``source_...``.

    A file offers its stem and every prefix that ends before an underscore,
    so the prefix rule is an equi-join too.
    """
    stem = T.file_stem("path")
    cut = F.split(stem, "_")
    keys = F.concat(F.array(F.struct(F.lit(0).alias("rank"), stem.alias("source"))),
                    F.transform(F.sequence(F.lit(1), F.greatest(F.size(cut) - 1, F.lit(1))),
                                lambda n: F.struct(
                                    F.lit(1).alias("rank"),
                                    F.when(F.size(cut) > n, F.array_join(F.slice(cut, 1, n), "_"))
                                    .alias("source"))))
    offers = (files.select("path", F.explode(keys).alias("k"))
              .select("path", "k.*").filter("source is not null")
              .groupBy("source").agg(F.min(F.struct("rank", "path")).alias("best")))
    return (mapping.join(offers, "source", "left")
            .select("source", "target", F.col("best.path").alias("path"),
                    F.col("best").isNotNull().alias("found")))


def copy_statistics(found: DataFrame, examples: int = 20) -> DataFrame:
    """Copied and missing counts and the first missing names."""
    first = (found.filter("not found").select("source").orderBy("source").limit(examples)
             .agg(F.array_join(F.array_sort(F.collect_list("source")), ", ").alias("missing_sources")))
    counts = found.agg(F.count("*").alias("expected"), F.count_if("found").alias("copied"),
                       F.count_if(~F.col("found")).alias("missing"))
    return counts.join(first, F.lit(True))


def existing_files(files: DataFrame, keys: DataFrame) -> DataFrame:
    """Files already stored for each key: key, a letter, anything.

    A file offers every beginning of its stem that is as long as some key and
    ends before a letter, so the test is an equi-join; it is listed for every
    key it belongs to.
    """
    # One number per length of keys.
    sizes = sorted(r[0] for r in keys.filter("sku <> ''").select(F.length("sku")).distinct().collect())
    stem = T.file_stem("path")
    starts = F.filter(F.lit(sizes).cast("array<int>"), lambda i: F.substring("stem", i + 1, F.lit(1)).rlike(r"\p{L}"))
    offers = (files.select("path", stem.alias("stem"))
              .select("path", F.explode(F.transform(starts, lambda i: F.substring("stem", F.lit(1), i))).alias("sku")))
    return offers.join(keys.select("sku").distinct(), "sku", "left_semi")


def folder_coverage(files: DataFrame, expected: DataFrame | None) -> DataFrame:
    """How many of the expected keys each folder has (folder, path, marked)."""
    pairs = (files.select("folder", "marked", T.leading_number(T.file_stem("path")).alias("sku"))
             .filter("sku is not null").distinct())
    if expected is not None:
        want = expected.select(T.leading_number("sku").alias("sku")).filter("sku is not null")
        pairs = pairs.withColumn("hit", F.lit(1)).join(
            want.distinct().withColumn("wanted", F.lit(1)), "sku", "left")
        covered = F.count_if(F.col("wanted").isNotNull())
    else:
        covered = F.count("*")
    return pairs.groupBy("folder").agg(covered.alias("coverage"), F.bool_or("marked").alias("marked"))


def pick_folder(coverage: DataFrame) -> DataFrame:
    """Marked folders first, then coverage, then the newest name."""
    key = F.struct(F.col("marked").cast("int"), "coverage", "folder")
    return coverage.agg(F.max_by(F.struct("folder", "coverage", "marked"), key).alias("best")) \
        .select("best.*")


def expected_scope(spark, listed: str | None) -> DataFrame | None:
    """'9266, 9321-black' -> a table of numeric prefixes; None when empty."""
    got = spark.range(1).select(F.explode(F.split(F.lit(listed or ""), ",")).alias("sku")).select(
        T.found(T.trim_any("sku"), r"^([0-9]+)").alias("sku")).filter("sku is not null").distinct()
    rows = rows_if_small(got, 1)
    return got if rows is None or rows else None


def size_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files, bytes and saving of two folders (length)."""
    def totals(df, mark):
        return df.agg(F.count("*").alias(f"{mark}_files"),
                      F.coalesce(F.sum("length"), F.lit(0)).alias(f"{mark}_bytes"))
    both = totals(before, "input").join(totals(after, "output"), F.lit(True))
    saved = F.col("input_bytes") - F.col("output_bytes")
    return both.withColumn("saved_bytes", saved).withColumn(
        "reduction_percent", F.when(F.col("input_bytes") > 0, saved / F.col("input_bytes") * 100)
        .otherwise(0.0))


def size_pairs(before: DataFrame, after: DataFrame, prefix: int = 2) -> DataFrame:
    """Each output file with the first input file of the same two letters."""
    pick = before.withColumn("lead", F.substring(T.file_stem("path"), 1, prefix)) \
        .groupBy("lead").agg(F.min_by(F.struct("path", "length"), "path").alias("original"))
    out = after.withColumn("lead", F.substring(T.file_stem("path"), 1, prefix))
    change = F.when(F.col("original.length") > 0, (F.col("original.length") - F.col("length"))
                    / F.col("original.length") * 100).when(F.col("original").isNotNull(), 0.0)
    status = (F.when(F.col("length") < F.col("original.length"), "DOWN")
              .when(F.col("length") > F.col("original.length"), "UP")
              .when(F.col("original").isNotNull(), "SAME"))
    return (out.join(pick, "lead", "left")
            .select("path", "length", F.col("original.path").alias("original_path"),
                    F.col("original.length").alias("original_length"),
                    change.alias("reduction_percent"), status.alias("status")))
