"""Secret scan with corpus-wide ownership frequency (operator 1), in DataFrame functions only.

Base spans come from three patterns.  Their values, without the punctuation around them,
are sought everywhere else in the corpus: after ``--key=``, in a path, behind an
underscore, with dots inside.  A value is looked up by one or two of its parts (runs of
letters and digits) and then compared as a whole by its hash.  All places of a value are
counted by distinct repositories and owners.  A value that many owners or repositories
hold is a copied example; one that few hold and that looks live is a credential of
theirs, and the method adds its bare places (kind ``owned``).

What is stored on the way are positions and hashes, never a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bloom
from .common import checkpointed, sized, text_of

#: The base patterns, their kinds in listed order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"        # AKIA[A-Z0-9]+ of 18 or more characters
HEX = r"[0-9a-f]{16,}"               # [0-9a-f]+ of 16 or more characters
KINDS = ("assign", "access", "hex", "owned")
RUN = r"[A-Za-z0-9+/_.=-]{11,}"      # where a value may stand bare: the alphabet of the base values
PART = r"[A-Za-z0-9]+"
EDGE = "+/_.=-"                       # punctuation that is no part of a value at its ends
SINGLE, PAIR = 11, 7                  # least characters of a value of one part, and of the two parts that others are looked up by
LONGEST = 2048                        # characters of the longest value that is sought in bare places
MAX_OWNERS, MAX_REPOS = 3, 20         # a value that more owners or repositories hold is a copied example
BLOCK = 100                           # neighbouring ids of a repository, where the documents name none
SALTS = 16                            # parts that the places of one value are dealt to
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|xxxx|1234567890|(.)\1{5}"


def _places(found: Column, gaps: Column, kind: int, value=lambda m: m) -> Column:
    """Spans of all matches from the matched strings and the strings between them.

    A match starts after the gaps and matches before it, so the code point
    positions are running sums of lengths.
    """
    n = F.size(found)
    lengths = F.arrays_zip(F.transform(F.slice(gaps, 1, n), lambda g: F.length(g)).alias("g"),
                           F.transform(found, lambda m: F.length(m)).alias("m"), found.alias("s"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        a = acc["at"] + x["g"]
        b = a + x["m"]
        one = F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"), value(x["s"]).alias("value"))
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.when(n > 0, F.aggregate(lengths, start, step, lambda acc: acc["out"])).otherwise(empty)


def _core(value: Column) -> Column:
    """The value without punctuation at its ends."""
    return F.trim(value, F.lit(EDGE))


def _parts(value: Column) -> Column:
    return _places(F.regexp_extract_all(value, F.lit(PART), F.lit(0)), F.split(value, PART, -1), 0)


def _keys(value: Column, parts: Column) -> Column:
    """Array of (off, key): every part of ``SINGLE`` characters, and every two neighbouring parts of ``PAIR``, that hold a digit."""
    def key(start: Column, end: Column) -> Column:
        s = F.substring(value, start + 1, end - start)
        return F.struct(start.alias("off"), F.length(s).alias("size"), F.when(s.rlike("[0-9]"), F.xxhash64(s)).alias("key"))

    singles = F.transform(parts, lambda p: key(p["start"], p["end"]))
    pairs = F.transform(F.slice(F.arrays_zip(parts.alias("a"), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))).alias("b")),
                                1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda z: key(z["a"]["start"], z["b"]["end"]))
    keep = lambda least: lambda k: (k["size"] >= least) & k["key"].isNotNull()
    return F.concat(F.filter(singles, keep(SINGLE)), F.filter(pairs, keep(PAIR)))


def _look_up(core: Column) -> Column:
    """The key by which a value is sought: of its one part, else of its longest two neighbours; null if it has none."""
    parts = _parts(core)
    keys = _keys(core, parts)
    own = F.filter(keys, lambda k: (F.size(parts) == 1) | (k["size"] > F.length(F.regexp_extract(F.substring(core, k["off"] + 1, k["size"]), PART, 0))))
    best = F.array_max(F.transform(own, lambda k: F.struct(k["size"].alias("size"), (-k["off"]).alias("back"), k["key"].alias("key"))))
    return F.when(F.length(core).between(SINGLE, LONGEST), best)


def base_spans(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo: Column) -> DataFrame:
    """doc_id, owner, repo, text_sha and the base spans of every whole text, one row per input row.

    A span has start, kind, end, and of its value the hash, whether it looks live, its
    length, and the place and hash of the key it is sought by."""
    df = docs.select(docs[id_col].alias("doc_id"), docs[owner_col].cast("string").alias("owner"),
                     repo.cast("string").alias("repo"), text_of(docs[text_col].cast("string")).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    df = df.select("doc_id", "owner", "repo", F.sha2("text", 256).alias("text_sha"),
                   *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in patterns.items()),
                   *(F.split("text", p, -1).alias(f"g_{k}") for k, p in patterns.items()))
    base = F.array_sort(F.concat(
        F.filter(_places(F.col("m_assign"), F.col("g_assign"), 0, lambda m: F.regexp_extract(m, ASSIGN, 2)),
                 lambda s: F.length(s["value"]) >= 12),
        _places(F.col("m_access"), F.col("g_access"), 1), _places(F.col("m_hex"), F.col("g_hex"), 2)))
    cored = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), _core(s["value"]).alias("core")))
    df = df.select("doc_id", "owner", "repo", "text_sha", cored.alias("cored"))
    sought = F.transform("cored", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), _hash(s["core"]).alias("hash"),
        _live(s["core"]).alias("live"), F.length(s["core"]).alias("size"), _look_up(s["core"]).alias("by")))
    return df.select("doc_id", "owner", "repo", "text_sha", sought.alias("base"))


def _hash(core: Column) -> Column:
    return F.substring(F.sha2(core, 256), 1, 32)


def bare_places(docs: DataFrame, values: DataFrame, text_col: str, owner_col: str, repo: Column) -> DataFrame:
    """(text_sha, owner, repo, hash, start, end): where the texts hold one of ``values`` (key, off, size, hash), bounded by
    anything but a letter or digit.

    The texts' keys pass a Bloom filter of the values' keys before they are shuffled,
    and the places of one key are dealt to several tasks."""
    text = text_of(docs[text_col].cast("string"))
    runs = docs.select(docs[owner_col].cast("string").alias("owner"), repo.cast("string").alias("repo"), F.sha2(text, 256).alias("text_sha"),
                       F.regexp_extract_all(text, F.lit(RUN), F.lit(0)).alias("m"), F.split(text, RUN, -1).alias("g"))
    runs = runs.select("owner", "repo", "text_sha", F.explode(F.filter(_places(F.col("m"), F.col("g"), 0), lambda r: r["value"].rlike("[0-9]"))).alias("r"))
    runs = runs.select("owner", "repo", "text_sha", F.col("r.start").alias("at"), F.col("r.value").alias("run"))
    runs = runs.withColumn("parts", _parts(F.col("run")))
    keys = runs.select("owner", "repo", "text_sha", "at", "run", F.explode(_keys(F.col("run"), F.col("parts"))).alias("k"))
    keys = keys.select("owner", "repo", "text_sha", "at", "run", F.col("k.off").alias("place"), F.col("k.key").alias("key"))
    n = values.count()
    blocks = bloom.blocks_for(n)
    if blocks is not None:
        keys = bloom.may_hold(keys, ["key"], checkpointed(sized(bloom.build(values, ["key"], blocks), n)), blocks)
    keys = keys.withColumn("salt", F.pmod(F.xxhash64("text_sha", "at"), F.lit(SALTS)).cast("int"))
    salted = values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = keys.join(salted, ["key", "salt"]).withColumn("start", F.col("place") - F.col("off"))
    edge = lambda at: ~F.substring(F.col("run"), at, F.lit(1)).rlike("[A-Za-z0-9]")
    met = met.where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.length("run")))
    met = met.where(_hash(F.substring("run", F.col("start") + 1, F.col("size"))) == F.col("hash"))
    met = met.where(((F.col("start") == 0) | edge(F.col("start"))) & edge(F.col("start") + F.col("size") + 1))
    return met.select("text_sha", "owner", "repo", "hash", (F.col("at") + F.col("start")).cast("int").alias("start"),
                      (F.col("at") + F.col("start") + F.col("size")).cast("int").alias("end")).distinct()


def ownership(places: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """One row per hash: distinct owners and repositories of its places (owner, repo, hash, live), and its verdict.

    Rows are first reduced to one per (hash, owner, repository) before the shuffle,
    so a value that a third of all rows hold reaches its task as a few rows.
    """
    rows = places.select(F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo"), "hash", "live")
    by_repo = rows.groupBy("hash", "owner", "repo").agg(F.max("live").alias("live"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("live").alias("live"))
    by_hash = by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("live").alias("live"))
    many = (F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos)
    verdict = F.when(many, "copied").when(F.col("live"), "live").otherwise("weak")
    return by_hash.select("hash", "n_owners", "n_repos", verdict.alias("verdict"))


def _live(value: Column) -> Column:
    """Looks like a live credential: digits and letters, varied characters, no placeholder word."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= 8
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & varied & ~value.rlike(PLACEHOLDER)


def shown(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order of the array."""
    kind = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _repository(docs: DataFrame, id_col: str, owner_col: str) -> Column:
    """Owner, language and block of a hundred neighbouring ids: what was fetched together."""
    block = [F.call_function("div", docs[id_col].cast("long"), F.lit(BLOCK))] if docs.schema[id_col].dataType.typeName() in ("integer", "long") else []
    lang = [docs["lang"].cast("string")] if "lang" in docs.columns else []
    return F.concat_ws("/", docs[owner_col].cast("string"), *lang, *(b.cast("string") for b in block))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo: Column | None = None, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Secret spans of every whole text with the ownership verdicts of its values.

    Returns one row per input row: doc_id, text_sha (of the text, null as empty), base
    (array of start, kind, end, hash and more) and all_spans (array of start, kind, end;
    code points, end exclusive, ordered by start and kind), n_live, n_copied (base spans
    whose value is an owner's live-looking credential, or a widely copied one), n_owners
    and n_repos (the most that a value of its base spans has).  A value held by more than
    ``max_owners`` owners or ``max_repos`` repositories is copied.  ``repo`` defaults to
    owner, language and block of neighbouring ids.

    A value is sought in bare places if it has 11 to 2048 characters without the
    punctuation at its ends, and holds a digit in its only part or in two neighbouring
    ones of seven characters; other values are counted where they are base values.  Null owners and repositories count
    as one unnamed owner or repository; null text has no spans; very long texts are
    scanned whole; null and equal ids and repeated rows each give their own row; other
    columns, whatever their names, are ignored; an empty table gives no rows.
    """
    if repo is None:
        repo = _repository(docs, id_col, owner_col)
    found = checkpointed(base_spans(docs, id_col, text_col, owner_col, repo))
    n = found.count()
    spans = found.select("text_sha", "owner", "repo", F.explode("base").alias("s"))
    sought = (spans.select("s.hash", "s.live", "s.size", "s.by").where("by IS NOT NULL")
              .groupBy("hash").agg(F.max("live").alias("live"), F.max("size").alias("size"), F.max("by").alias("by")))
    values = checkpointed(sized(sought.select("hash", "live", "size", F.col("by.key").alias("key"), (-F.col("by.back")).alias("off")), n))
    bare = checkpointed(sized(bare_places(docs, values.drop("live"), text_col, owner_col, repo), n))
    known = spans.select("owner", "repo", "s.hash", "s.live")
    # a bare place's value is a base value somewhere, which says whether it looks live
    known = known.unionByName(bare.select("owner", "repo", "hash", F.lit(False).alias("live")))
    verdicts = checkpointed(sized(ownership(known, max_owners, max_repos), n))

    one = found.where("size(base) > 0").select("text_sha", "base").dropDuplicates(["text_sha"])
    places = one.select("text_sha", F.explode("base").alias("s")).select("text_sha", "s.start", "s.kind", "s.end", "s.hash").unionByName(
        bare.select("text_sha", "start", F.lit(3).alias("kind"), "end", "hash").distinct())
    salt = F.pmod(F.xxhash64("text_sha"), F.lit(SALTS)).cast("int")
    salted = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    is_base, live = F.col("kind") < 3, F.col("verdict") == "live"
    judged = (places.withColumn("salt", salt).join(salted, ["hash", "salt"]).groupBy("text_sha").agg(
        F.collect_list(F.when(~is_base & live, F.struct("start", "kind", "end"))).alias("added"),
        F.count_if(is_base & live).alias("n_live"), F.count_if(is_base & (F.col("verdict") == "copied")).alias("n_copied"),
        F.max(F.when(is_base, F.col("n_owners"))).alias("n_owners"), F.max(F.when(is_base, F.col("n_repos"))).alias("n_repos")))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    added = F.filter(F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")),
                     lambda a: ~F.exists("base", lambda b: (b["start"] <= a["start"]) & (b["end"] >= a["end"])))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select("doc_id", "text_sha", "base").join(judged, "text_sha", "left").select(
        "doc_id", "text_sha", "base", F.array_sort(F.concat(plain, added)).alias("all_spans"), *map(zero, ("n_live", "n_copied", "n_owners", "n_repos")))


def digests(scanned: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as a string."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                          F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("all_spans")).alias("spans"),
                          "n_live", "n_copied", "n_owners", "n_repos")


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans become one mark.

    Rows, their other columns and null texts stay as they are; ties and repeated rows are
    treated alike, very long texts whole; an empty table stays empty.
    """
    spans = (scan(docs, **options).where("size(all_spans) > 0").dropDuplicates(["text_sha"])
             .select(F.col("text_sha").alias("__sha"), F.col("all_spans").alias("__spans")))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        more = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, more).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("__spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    kept = [c for c in docs.columns if c != "text"]
    out = docs.withColumn("__sha", F.sha2(text_of(text), 256)).join(spans, "__sha", "left")
    return out.select(*kept, F.when(F.col("__spans").isNotNull(), clean).otherwise(text).alias("text")).select(*docs.columns)
