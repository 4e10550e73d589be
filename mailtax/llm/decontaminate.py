"""Benchmark decontamination by templates, in DataFrame functions only.

Words are letters or numbers in sequence; in scripts without spaces each character is a word. Numbers, units after a number and
names (capitalised words of two letters or more that do not begin a sentence) become typed placeholders, so a question asked
again with other numbers or names has the same template. Windows of ``window`` words of documents and benchmark items are joined on
a 64-bit hash of their template; windows with more placeholders than words say too little and are left out.

Matching windows then have to fill their slots consistently. A document may hold a question several times, each time with other
fillers, so slots are bound per occurrence: windows of one occurrence lie at nearly the same distance (place in the document less
place in the item). Distances are cut into cells as wide as the item, by two grids half a cell apart, so words put in between
leave an occurrence in one cell of either grid, and two occurrences never share a cell. In a cell each value of the item is
bound to the document's value found in most windows, and windows that contradict a binding do not count. An item is contained in
the document if some cell has a share of at least ``share`` of the item's windows left, or PASSAGE of them.

Besides, windows of the plain words in lower case are joined, with numbers and names as they are: so copies are found whatever
their case, and those of items that are mostly numbers or names and of items shorter than a window (their windows are as long as
the item). One pass over the texts makes both kinds of hashes and keeps those that an item has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut
from mailtax.llm.common import row_key

WINDOW = 5
SHARE = 0.5
PASSAGE = 9  # windows, 13 words if they follow each other
MAX_BROADCAST_ROWS = 1_000_000
MAX_LITERALS = 50_000  # hashes that are tested in place; more are joined
# Units of measure.
UNITS = (
    "mm cm m km in ft yd mi miles mile meters metres kilometers kilometres mg g kg lb lbs oz tons ton grams kilograms "
    "ml l liters litres gallons s sec seconds second min minutes minute h hr hours hour days day weeks week months month "
    "years year usd eur gbp dollars dollar cents euros euro pounds percent degrees mph kmh"
).split()
# Characters that stand for a sentence start, a name, a number and a unit; where a text holds them itself they count as such.
START, NAME, NUMBER, UNIT = "\x01", "\x02", "\x03", "\x04"
SENTENCE_START = r"(^|[.!?:;\n][ \t\n\r]*)(\p{Lu})"
CAPITALISED = r"(^|[^\x01\p{L}])(\p{Lu}\p{L})"
FIGURES = r"[0-9]+(?:[.,][0-9]+)*"
SPACELESS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
BEYOND_SPACES = r"[^\x{0}-\x{DFF}]"  # texts without such a character hold none of the scripts above
WORD = rf"{FIGURES}|\x02?\p{{L}}+"
PAIR = ["k1", "k2", "item_id"]
CELL = ["grid", "cell"]


def _words(text: Column) -> Column:
    """Words in lower case, names with a mark before them."""
    marked = F.regexp_replace(F.regexp_replace(text, SENTENCE_START, f"$1{START}$2"), CAPITALISED, f"$1{NAME}$2")
    low = F.lower(marked)
    spaced = F.when(F.rlike(text, F.lit(BEYOND_SPACES)), F.regexp_replace(low, f"([{SPACELESS}])", " $1 ")).otherwise(low)
    return F.regexp_extract_all(spaced, F.lit(WORD), F.lit(0))


def _number(word: Column) -> Column:
    return F.substring(word, 1, 1).between("0", "9")


def _templated(word: Column, before: Column) -> Column:
    """What stands for a word in a template, after the word ``before`` it (null: none)."""
    unit = word.isin(*UNITS) & F.coalesce(_number(before), F.lit(False))
    return F.when(_number(word), NUMBER).when(F.startswith(word, F.lit(NAME)), NAME).when(unit, UNIT).otherwise(word)


def _template(words: str) -> Column:
    return F.transform(words, lambda x, i: _templated(x, F.get(words, i - 1)))


def _plain(word: Column) -> Column:
    return F.translate(word, NAME, "")


def _run_hash(hashes: str, first: Column, width: int) -> Column:
    """Hash of ``width`` word hashes from ``first`` on."""
    return F.xxhash64(*[F.get(hashes, first + k) for k in range(width)])


def _starts(hashes: str, width: int) -> Column:
    """First places of the runs of ``width``; none if there are fewer words."""
    return F.when(F.size(hashes) >= width, F.sequence(F.lit(0), F.size(hashes) - width)).otherwise(F.array().cast("array<int>"))


def _window_hashes(hashes: str, width: int) -> Column:
    return F.transform(_starts(hashes, width), lambda i: _run_hash(hashes, i, width))


def _hashed(rows: DataFrame, window: int, widths: list[int]) -> DataFrame:
    """``rows`` (column ``text``) with the arrays ``templates`` and ``plains`` of window hashes; a text shorter than a window is
    one template window. The words are taken out once."""
    words = rows.withColumn("words", _words(F.col("text"))).drop("text")
    hashes = words.select(
        *[c for c in words.columns if c != "words"],
        F.transform("words", lambda x, i: F.xxhash64(_templated(x, F.get("words", i - 1)))).alias("t"),
        F.transform("words", lambda x: F.xxhash64(_plain(x))).alias("p"),
    )
    plains = F.concat(*[_window_hashes("p", w) for w in widths]) if widths else F.array().cast("array<bigint>")
    short = F.when(F.size("t") > 0, F.array(F.xxhash64("t"))).otherwise(F.array().cast("array<bigint>"))
    return hashes.select(
        *[c for c in hashes.columns if c not in ("t", "p")],
        F.when(F.size("t") >= window, _window_hashes("t", window)).otherwise(short).alias("templates"), plains.alias("plains"),
    )


def _placed_windows(rows: DataFrame, window: int) -> DataFrame:
    """One row per template window of ``rows`` (column ``text``): ``place``, ``hash``, ``fillers`` (empty for words that stand for
    themselves) and ``size``, the words of the text."""
    words = rows.withColumn("words", _words(F.col("text"))).drop("text").withColumn("template", _template("words"))
    slots = F.zip_with("template", "words", lambda t, w: F.when(t.isin(NAME, NUMBER, UNIT), w).otherwise(""))
    filled = words.withColumn("filled", slots).withColumn("t", F.transform("template", lambda x: F.xxhash64(x)))
    starts = F.when(F.size("t") >= window, _starts("t", window)).when(F.size("t") > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    found = F.transform(starts, lambda i: F.struct(
        i.alias("place"), F.when(F.size("t") >= window, _run_hash("t", i, window)).otherwise(F.xxhash64("t")).alias("hash"),
        F.slice("filled", i + 1, window).alias("fillers"),
    ))
    kept = [c for c in rows.columns if c != "text"]
    return filled.select(*kept, F.size("t").alias("size"), F.explode(found).alias("w")).select(*kept, "size", "w.*")


def _plain_items(asked: DataFrame, window: int) -> tuple[DataFrame, list[int]]:
    """``item_id, hash`` of the plain windows of items (``item_id, text``), as wide as ``window`` or the item, and their widths."""
    words = asked.select("item_id", F.transform(_words(F.col("text")), lambda x: F.xxhash64(_plain(x))).alias("p"))
    sized = cut(words.withColumn("width", F.least(F.size("p"), F.lit(window))).where("width > 0"))
    widths = sorted(row["width"] for row in sized.select("width").distinct().collect())
    runs = F.array().cast("array<bigint>")
    for w in widths:
        runs = F.when(F.col("width") == w, _window_hashes("p", w)).otherwise(runs)
    return cut(sized.select("item_id", F.explode(runs).alias("hash")).distinct()), widths


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast, if its size, which is counted here, allows it; otherwise the join shuffles both sides."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def _hits(hashed: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """``k1, k2, kind, hash``: the different hashes of the arrays that the table of their kind has.

    Up to MAX_LITERALS hashes are tested in place, so that only hits become rows; more are joined.
    """
    few = all(w.count() <= MAX_LITERALS for w in wanted.values())

    def own(kind: str) -> Column:
        if not few:
            return F.array_distinct(kind)
        literals = [r["hash"] for r in wanted[kind].collect()]
        return F.array_distinct(F.filter(kind, lambda x: x.isin(literals))) if literals else F.slice(kind, 1, 0)

    both = F.array(*[F.struct(F.lit(kind).alias("kind"), own(kind).alias("hashes")) for kind in wanted])
    found = hashed.select("k1", "k2", F.inline(both)).select("k1", "k2", "kind", F.explode("hashes").alias("hash"))
    if not few:
        tables = [w.select(F.lit(kind).alias("kind"), "hash") for kind, w in wanted.items()]
        found = found.join(_small(cut(tables[0].union(tables[1]))), ["kind", "hash"], "left_semi")
    return cut(found.distinct())


def contained_items(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, share: float = SHARE,
) -> DataFrame:
    """``k1, k2, item_id, matched``: items contained in rows of ``df`` and the windows that match, in the occurrence with most.

    First the hashes alone are matched, which needs no fillers and no places; the few documents that share enough template
    windows with an item are then read again with theirs. Items whose plain windows alone match come with the number of those.
    """
    asked = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    items = _placed_windows(asked, window)
    wordy = F.size(F.array_remove("fillers", "")) * 2 <= F.size("fillers")
    items = cut(items.where(wordy).distinct())
    plain, widths = _plain_items(asked, window)

    def enough(counted: DataFrame, windows: DataFrame) -> DataFrame:
        totals = cut(windows.groupBy("item_id").agg(F.countDistinct("hash").alias("windows")))
        return counted.join(totals, counted["item_id"].eqNullSafe(totals["item_id"])).where(
            F.col("matched") >= F.least(share * F.col("windows"), F.lit(float(PASSAGE)))
        ).select("k1", "k2", counted["item_id"], "matched")

    def per_pair(hits: DataFrame, windows: DataFrame) -> DataFrame:
        owners = _small(cut(windows.select("hash", "item_id").distinct()))
        return hits.join(owners, "hash").groupBy(*PAIR).agg(F.count("*").alias("matched"))

    rows = df.select(*row_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = _hashed(rows, window, widths)
    hits = _hits(hashed, {"templates": cut(items.select("hash").distinct()), "plains": cut(plain.select("hash").distinct())})
    copies = cut(enough(per_pair(hits.where("kind = 'plains'"), plain), plain))
    likely = cut(enough(per_pair(hits.where("kind = 'templates'"), items), items).select(*PAIR))

    documents = _small(cut(likely.select("k1", "k2").distinct()))
    again = _placed_windows(rows.join(documents, ["k1", "k2"], "left_semi"), window)
    again = again.select("k1", "k2", "hash", F.col("place").alias("at"), F.col("fillers").alias("mine"))
    pairs = likely.select(*[F.col(c).alias(f"l_{c}") for c in PAIR])
    asked_for = (F.col("k1") == F.col("l_k1")) & (F.col("k2") == F.col("l_k2")) & F.col("item_id").eqNullSafe(F.col("l_item_id"))
    apart = F.col("at") - F.col("place")
    cells = F.array(*[
        F.struct(F.lit(g).alias("grid"), F.floor((apart * 2 + g * F.col("size")) / (2 * F.col("size"))).alias("cell")) for g in (0, 1)
    ])
    met = cut(
        again.join(_small(items), "hash").join(pairs, asked_for, "left_semi")
        .select(*PAIR, "hash", "fillers", "mine", F.inline(cells)).distinct()
    )
    values = met.select(*PAIR, *CELL, "hash", F.explode(F.arrays_zip("fillers", "mine")).alias("s")).where("s.fillers <> ''")
    bound = (
        values.groupBy(*PAIR, *CELL, F.col("s.fillers").alias("theirs"), F.col("s.mine").alias("mine"))
        .agg(F.countDistinct("hash").alias("n"))
        .groupBy(*PAIR, *CELL, "theirs").agg(F.max_by("mine", F.struct("n", "mine")).alias("mine"))
        .groupBy(*PAIR, *CELL).agg(F.map_from_entries(F.collect_list(F.struct("theirs", "mine"))).alias("bound"))
        .select(*[F.col(c).alias(f"b_{c}") for c in (*PAIR, *CELL)], "bound")
    )
    same = F.col("item_id").eqNullSafe(F.col("b_item_id"))
    for c in ("k1", "k2", *CELL):
        same = same & (F.col(c) == F.col(f"b_{c}"))
    agrees = F.forall(F.zip_with("fillers", "mine", lambda f, m: (f == "") | (F.col("bound")[f] == m)), lambda x: x)
    kept = met.join(bound, same, "left").where(F.col("bound").isNull() | agrees)
    counted = kept.groupBy(*PAIR, *CELL).agg(F.countDistinct("hash").alias("matched")).groupBy(*PAIR).agg(F.max("matched").alias("matched"))
    found = cut(enough(counted, items))
    other = found.select(*[F.col(c).alias(f"o_{c}") for c in PAIR])
    known = (F.col("k1") == F.col("o_k1")) & (F.col("k2") == F.col("o_k2")) & F.col("item_id").eqNullSafe(F.col("o_item_id"))
    return found.union(copies.join(other, known, "left_anti"))


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: ``doc_id, contaminated, items`` (sorted ids of contained items, comma-joined), ``matched``
    (their windows found).

    Null texts are empty and contain nothing. A text shorter than a window is one template window, which only texts of the
    same template share; its plain words are found inside of any text. Items with equal text are all reported; repeated rows each get their row; a null item id counts as an
    item whose id is not shown. Empty tables: nothing is contaminated.
    """
    found = (
        contained_items(df, benchmark, id_col, text_col, **options).groupBy("k1", "k2")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("item_id")), lambda x: x.cast("string")), ",").alias("items"),
             F.sum("matched").alias("matched"))
    )
    return (
        df.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col))
        .join(cut(found), ["k1", "k2"], "left")
        .select("doc_id", F.col("matched").isNotNull().alias("contaminated"), F.coalesce("items", F.lit("")).alias("items"),
                F.coalesce("matched", F.lit(0)).alias("matched"))
    )


def keep_clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that contain no benchmark item."""
    found = cut(contained_items(df, benchmark, id_col, text_col, **options).select("k1", "k2").distinct())
    k1, k2 = row_key(id_col, text_col)
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), k1, k2)
    return packed.join(found, ["k1", "k2"], "left_anti").select("row.*")


def decontaminate_sql(window: int = WINDOW, share: float = SHARE) -> str:
    """DuckDB SQL for ``decontaminate(documents, benchmark)``; it joins the windows' words themselves, not hashes."""
    scripts = "Han Hiragana Katakana Thai Lao Khmer Myanmar".split()
    spaceless = "".join(f"\\p{{{s}}}" for s in scripts)
    units = ", ".join(f"'{u}'" for u in UNITS)
    marked = (
        f"lower(regexp_replace(regexp_replace(text, '{SENTENCE_START}', '\\1' || chr(1) || '\\2', 'g'), "
        f"'{CAPITALISED}', '\\1' || chr(2) || '\\2', 'g'))"
    )
    tokens = f"regexp_extract_all(regexp_replace({marked}, '([{spaceless}])', ' \\1 ', 'g'), '{FIGURES}|\\x02?\\p{{L}}+')"

    def words(table: str, key: str) -> str:
        return f"""(
          SELECT r, {key}, n, i, replace(x, chr(2), '') AS plain, tmpl, CASE WHEN tmpl IN (chr(2), chr(3), chr(4)) THEN x ELSE '' END AS filler
          FROM (SELECT *, CASE WHEN x SIMILAR TO '[0-9].*' THEN chr(3) WHEN x[1] = chr(2) THEN chr(2)
                               WHEN x IN ({units}) AND lag(x) OVER (PARTITION BY r ORDER BY i) SIMILAR TO '[0-9].*' THEN chr(4) ELSE x END AS tmpl
                FROM (SELECT r, {key}, len(toks) AS n, unnest(toks) AS x, generate_subscripts(toks, 1) AS i
                      FROM (SELECT row_number() OVER () AS r, {key}, {tokens} AS toks FROM (SELECT {key}, coalesce(text, '') AS text FROM {table})))))"""

    def windows(table: str, key: str) -> str:
        ahead = ", ".join(f"lead(tmpl, {k}) OVER w AS t{k}, lead(filler, {k}) OVER w AS f{k}" for k in range(1, window))
        cells = [("tmpl", "filler")] + [(f"t{k}", f"f{k}") for k in range(1, window)]
        template = " || ' ' || ".join(f"coalesce({t}, '')" for t, _ in cells)
        fillers = ", ".join(f"coalesce({f}, '')" for _, f in cells)
        filled = " + ".join(f"(coalesce({f}, '') <> '')::INT" for _, f in cells)
        return f"""(
          SELECT r, {key}, n, i, {template} AS template, [{fillers}] AS fillers, 2 * ({filled}) <= least(n, {window}) AS wordy
          FROM (SELECT *, {ahead} FROM {table} WINDOW w AS (PARTITION BY r ORDER BY i)) WHERE i = 1 OR i + {window - 1} <= n)"""

    def plain(table: str, key: str, width: int, where: str) -> str:
        ahead = "".join(f" || ' ' || lead(plain, {k}) OVER w" for k in range(1, width))
        return f"SELECT r, {key}, {width} AS width, plain{ahead} AS run FROM {table} WHERE {where} WINDOW w AS (PARTITION BY r ORDER BY i)"

    item_runs = " UNION ALL ".join(plain("iw", "item_id", w, f"least(n, {window}) = {w}") for w in range(1, window + 1))
    doc_runs = " UNION ALL ".join(plain("dw", "doc_id", w, f"{w} IN (SELECT least(n, {window}) FROM iw)") for w in range(1, window + 1))
    enough = f"matched >= least({share} * windows, {PASSAGE})"
    return f"""
    WITH dw AS MATERIALIZED (SELECT * FROM {words('documents', 'doc_id')}), iw AS MATERIALIZED (SELECT * FROM {words('benchmark', 'item_id')}),
    items AS (SELECT DISTINCT item_id, n, i, template, fillers FROM {windows('iw', 'item_id')} WHERE wordy),
    totals AS (SELECT item_id, count(DISTINCT template) AS windows FROM items GROUP BY 1),
    all_met AS (SELECT d.r, q.item_id, q.template, q.fillers, d.fillers AS mine, d.i - q.i AS apart, q.n AS size
                FROM {windows('dw', 'doc_id')} d JOIN items q USING (template)),
    likely AS (SELECT r, item_id FROM (SELECT r, item_id, count(DISTINCT template) AS matched FROM all_met GROUP BY 1, 2)
               JOIN totals USING (item_id) WHERE {enough}),
    met AS (SELECT DISTINCT r, item_id, template, fillers, mine, grid, CAST(floor((2 * apart + grid * size) / (2.0 * size)) AS BIGINT) AS cell
            FROM all_met SEMI JOIN likely USING (r, item_id), (VALUES (0), (1)) g(grid)),
    vals AS (SELECT r, item_id, grid, cell, template, unnest(fillers) AS theirs, unnest(mine) AS mine FROM met),
    counted AS (SELECT r, item_id, grid, cell, theirs, mine, count(DISTINCT template) AS n FROM vals WHERE theirs <> '' GROUP BY ALL),
    bound AS (SELECT r, item_id, grid, cell, theirs, mine FROM counted
              QUALIFY row_number() OVER (PARTITION BY r, item_id, grid, cell, theirs ORDER BY n DESC, mine DESC) = 1),
    wrong AS (SELECT DISTINCT m.r, m.item_id, m.grid, m.cell, m.template, m.fillers, m.mine
              FROM (SELECT *, unnest(fillers) AS theirs, unnest(mine) AS own FROM met) m
              JOIN bound b USING (r, item_id, grid, cell, theirs) WHERE b.mine <> m.own),
    kept AS (SELECT r, item_id, max(matched) AS matched FROM (
               SELECT r, item_id, grid, cell, count(DISTINCT template) AS matched FROM (
                 SELECT r, item_id, grid, cell, template, fillers, mine FROM met
                 EXCEPT SELECT r, item_id, grid, cell, template, fillers, mine FROM wrong) GROUP BY ALL) GROUP BY 1, 2),
    found AS (SELECT r, item_id, matched FROM kept JOIN totals USING (item_id) WHERE {enough}),
    item_runs AS (SELECT DISTINCT item_id, width, run FROM ({item_runs}) WHERE run IS NOT NULL),
    run_totals AS (SELECT item_id, count(*) AS windows FROM item_runs GROUP BY 1),
    copies AS (SELECT r, item_id, matched FROM (
                 SELECT r, item_id, count(DISTINCT run) AS matched FROM ({doc_runs}) d JOIN item_runs USING (width, run) GROUP BY 1, 2)
               JOIN run_totals USING (item_id) WHERE {enough}),
    both_kinds AS (SELECT * FROM found UNION ALL SELECT * FROM copies ANTI JOIN found USING (r, item_id)),
    done AS (SELECT r, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, CAST(sum(matched) AS BIGINT) AS matched
             FROM both_kinds GROUP BY 1)
    SELECT doc_id, done.r IS NOT NULL AS contaminated, coalesce(items, '') AS items, coalesce(matched, 0) AS matched
    FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) d LEFT JOIN done USING (r)"""
