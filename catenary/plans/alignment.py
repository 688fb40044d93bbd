"""Queries of selectors, statements, alignment, the atom graph, policy, publication and feeds, over the shop tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.claims import claim_id
from ..functions.content import strict_date
from ..functions.text import clean
from ..operators import align as A
from ..operators import graph as G
from ..operators import link as L
from ..operators import pipeline as PL
from ..operators import review as V
from ..operators import semantics as S
from ..operators.components import components
from ..operators.numbering import numbered
from ..session import Cut
from ..sources import catalogs as C
from ..sources.tables import table


def lines(s: SparkSession, d: str) -> DataFrame:
    """Order lines by order and number; the table may have several rows for one line."""
    return table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("extent"), F.max("l_returnflag").alias("flag"), F.min("l_partkey").alias("part"))


def sel_domain_rank(s, d):
    rows = table(s, d, "part").select(F.col("p_type").alias("entity"), F.lit("size").alias("dimension"), F.col("p_size").cast("string").alias("value"))
    return S.ranked_domain(rows.unionByName(table(s, d, "part").select(F.col("p_type").alias("entity"), F.lit("brand").alias("dimension"), F.col("p_brand").alias("value"))))


def part_units(s, d):
    return table(s, d, "part").select(F.col("p_type").alias("entity"), F.concat(F.lit("part://"), F.col("p_partkey").cast("string")).alias("reference"), F.lit("part").alias("level"), F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.col("p_brand")).alias("attributes"))


def sel_units(s, d):
    """For each type: parts of the two first brands in sizes 30 down to 10."""
    domain = sel_domain_rank(s, d)
    brands = domain.where("dimension = 'brand' AND position <= 2").groupBy("entity").agg(F.array_sort(F.collect_list("value")).alias("items"))
    none = F.lit(None).cast("string")
    asked = brands.select(F.concat(F.lit("q:"), "entity").alias("question"), "entity", F.lit("part").alias("level"), F.lit("brand").alias("dimension"), F.lit("set").alias("kind"), "items", none.alias("low"), none.alias("high"))
    sizes = brands.select(F.concat(F.lit("q:"), "entity").alias("question"), "entity", F.lit("part").alias("level"), F.lit("size").alias("dimension"), F.lit("range").alias("kind"), F.array().cast("array<string>").alias("items"), F.lit("30").alias("low"), F.lit("10").alias("high"))
    return S.select_units(part_units(s, d), domain, asked.unionByName(sizes)).select("question", "reference")


def sel_order_units(s, d):
    rows = table(s, d, "part").select(F.col("p_brand").alias("entity"), F.lit("part").alias("level"), F.concat(F.lit("part://"), F.col("p_partkey").cast("string")).alias("reference"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("rank"))
    return S.ordered_units(rows, {"size": "rank"}).select("entity", "reference", "ordinal")


def sem_violations(s, d):
    rows = table(s, d, "lineitem").select(F.concat(F.lit("c"), F.col("l_orderkey").cast("string")).alias("claim_id"), F.lit(0).alias("side"), F.concat(F.lit("part://"), F.col("l_partkey").cast("string")).alias("reference"), F.col("l_quantity").cast("bigint").alias("extent"), F.col("l_linenumber").cast("string").alias("coordinate"))
    return S.resolution_violations(rows)


def sem_evaluate(s, d):
    o = table(s, d, "orders")
    side = lambda n, status: o.where(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("claim_id")).agg(F.count("*").alias("members"), F.sum(F.col("o_orderkey") % 4 + 1).cast("decimal(38,0)").alias("total"), F.array_sort(F.collect_list(F.col("o_orderkey") % 4 + 1)).alias("extents")).select("claim_id", F.when(F.col("claim_id") % 3 == 0, "<=>").when(F.col("claim_id") % 3 == 1, "<~>").otherwise("=>").alias("operator"), F.lit(n).alias("side"), "members", (F.col("claim_id") % 2 == 0).alias("ordered"), (F.col("claim_id") % 5 == 0).alias("dynamic"), "total", "extents", F.array().cast("array<string>").alias("coordinates"))
    return S.evaluate(side(0, "F").unionByName(side(1, "O"))).withColumn("claim_id", F.col("claim_id").cast("bigint")).select("claim_id", "verdict", "positional", F.col("unmapped_left").cast("bigint").alias("unmapped_left"), F.col("unmapped_right").cast("bigint").alias("unmapped_right"))


def _sides(s, d):
    left = lines(s, d).select(F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("ordinal"), "extent")
    total = left.groupBy("claim_id").agg(F.sum("extent").alias("total"))
    right = total.select("claim_id", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("total") / 10)).cast("int"))).alias("ordinal"), F.lit(10).cast("bigint").alias("extent"))
    return left, right


def sem_align_extent(s, d):
    rows = A.align_extents(*_sides(s, d))
    return rows.select("claim_id", "left_ordinal", "right_ordinal", *[F.col(c).cast("bigint").alias(c) for c in ("left_offset", "right_offset", "shared")])


def sem_tails(s, d):
    return A.tails(*_sides(s, d)).select("claim_id", "side", "ordinal", F.col("covered").cast("bigint").alias("covered"), F.col("extent").cast("bigint").alias("extent"))


def sem_zip(s, d):
    o = table(s, d, "orders")
    side = lambda status: o.where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("claim_id"), F.col("o_orderkey").alias("ordinal"))
    return A.zip_members(side("F"), side("O")).select("claim_id", "left_ordinal", "right_ordinal")


def aln_islands(s, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    rows = lines(s, d).where("flag = 'N'")
    return A.islands(rows, ("l_orderkey",), "l_linenumber", F.col("l_linenumber") != F.lag("l_linenumber").over(w) + 1).groupBy("l_orderkey", "island").agg(F.min("l_linenumber").alias("first"), F.max("l_linenumber").alias("last")).select("l_orderkey", "first", "last")


def _runs(s, d):
    """Line numbers as episodes of seasons: two orders after each other make a parent."""
    rows = lines(s, d).where("flag <> 'R'")
    return rows.select((F.floor(F.col("l_orderkey") / 4)).alias("parent"), F.lit(1).alias("run"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("left_at"), (F.col("l_orderkey") % 4).alias("left_season"), F.col("l_linenumber").alias("left_episode"))


def aln_spans(s, d):
    return A.spans(_runs(s, d), ("parent", "run"), "left").select("parent", "season_start", "season_end", "episode_start", "episode_end")


def aln_expressions(s, d):
    return A.run_expressions(_runs(s, d), ("parent", "run"), "left", F.concat(F.lit("shop://order/"), F.col("parent").cast("string")), F.lit("kind=default")).select("parent", "expression")


def aln_unique_match(s, d):
    p = table(s, d, "part")
    linked = F.when(F.col("p_partkey") % 50 == 0, F.concat(F.lit("r"), (F.col("p_partkey") % 100 + 1).cast("string")))
    rows = p.select(F.lit(1).alias("k"), F.concat(F.when(F.col("p_partkey") % 2 == 0, "l").otherwise("r"), F.col("p_partkey").cast("string")).alias("reference"), linked.alias("linked_reference"), "p_name", "p_type", "p_size", (F.col("p_partkey") % 2).alias("side"))
    return A.match_unique(rows.where("side = 0"), rows.where("side = 1"), ("k",), ("p_name", "p_type", "p_size")).select("left_reference", "right_reference")


def aln_dates(s, d):
    rows = table(s, d, "episodes").groupBy("episode_id").agg(F.max(F.coalesce("air_date", F.lit(""))).alias("t"))
    return rows.select("episode_id", strict_date(F.col("t")).alias("day")).where("day IS NOT NULL")


def aln_statements(s, d):
    """Customers' orders as episodes of years, against the same without some: the runs that are left, as statements."""
    o = table(s, d, "orders").select(F.col("o_custkey").alias("parent"), F.concat(F.lit("o://"), F.col("o_orderkey").cast("string")).alias("reference"), F.year("o_orderdate").alias("season"), F.col("o_orderkey").alias("k"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("air_date"), F.lit(None).cast("string").alias("linked_reference"), F.concat(F.lit("shop://c/"), F.col("o_custkey").cast("string")).alias("order_ref"), "o_orderstatus")
    rows = o.withColumn("episode", F.row_number().over(Window.partitionBy("parent", "season").orderBy("k")))
    return A.aligned_statements(rows, rows.where("o_orderstatus <> 'P'").withColumn("order_ref", F.concat("order_ref", F.lit("/b"))))


def pip_hierarchy(s, d):
    """Statements under pairs of shows that some link between their episodes names: their episodes as default orders, aligned."""
    e = table(s, d, "episodes").groupBy("episode_id").agg(F.max(F.struct("source", "order_ref", "reference", "season", "episode", "title", "air_date", "linked_reference")).alias("r")).select("r.*")
    e = Cut(e.where("season IS NOT NULL AND episode IS NOT NULL"), "orders").df
    linked = e.alias("x").join(e.alias("y"), F.col("x.linked_reference") == F.col("y.reference")).where("x.source = 'org.themoviedb' AND y.source = 'com.thetvdb'").select(F.col("x.order_ref").alias("a"), F.col("y.order_ref").alias("b")).distinct()
    accepted = linked.select(F.concat_ws(" <=> ", F.least("a", "b"), F.greatest("a", "b")).alias("statement")).select(claim_id(F.col("statement")).alias("claim_id"), F.lit(1).cast("bigint").alias("version"), "statement")
    found, _ = PL.hierarchy_supports(accepted, e.select("order_ref", F.lit(None).cast("string").alias("context"), "reference", "season", "episode", "title", "air_date", "linked_reference"))
    return found.select("claim_id", "statement", "method")


def rev_violations(s, d):
    """Reviews of every other order's claim, against decisions, candidates and evidence made of its number."""
    k = F.col("o_orderkey")
    o = table(s, d, "orders").select(k, F.concat(F.lit("c"), k.cast("string")).alias("claim_id"))
    requests = o.where(k % 10 < 5).select("claim_id", F.lit("a://1 <=> b://1\n").alias("record"), F.when(k % 2 == 0, "accepted").otherwise("rejected").alias("action"), F.when(k % 3 == 0, " ").otherwise("seen").alias("note"), F.when(k % 4 > 0, k % 4).alias("expected_version"), F.when(k % 5 > 0, k % 5).alias("expected_revision"))
    in_force = o.where(k % 4 > 0).select("claim_id", (k % 4 + F.when(k % 7 == 0, 1).otherwise(0)).alias("version"))
    return V.review_violations(requests, in_force, o.where(k % 3 != 1).select("claim_id", (k % 5).alias("revision")), o.where(k % 6 != 0), o.where(k % 11 == 0).select("claim_id", F.lit("Invalid: counts differ").alias("verdict")), o.where(k % 13 == 0))


def rev_pending(s, d):
    """Decisions on customers' first orders, then reviews of a part of them: what waits to be published."""
    k = F.col("o_custkey")
    claim = F.concat(F.lit("c"), k.cast("string"))
    o = table(s, d, "orders").select(k).distinct()
    events = o.select(claim.alias("claim_id"), k.alias("version"), F.concat(F.lit("r"), k.cast("string")).alias("record"), F.lit("accepted").alias("action"), F.lit("n").alias("note"))
    requests = o.where((k % 50 == 0) & (k <= 40_000)).select(claim.alias("claim_id"), F.concat(F.lit("n"), k.cast("string")).alias("record"), F.when(k % 100 == 0, "retracted").otherwise("accepted").alias("action"), F.lit("n").alias("note"), F.when(k % 100 != 0, F.concat(F.lit("c"), (k + 1).cast("string"))).alias("replaces"))
    out = PL.saved_decisions(events, requests)
    return PL.pending_decisions(out["pending"], out["decisions"])


def pub_bindings(s, d):
    """What selections of customers' orders stood for, or why not, written into bindings and read back."""
    o = table(s, d, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("claim_id"), F.concat(F.lit("o://"), "o_orderstatus", F.lit(" :: **")).alias("selection_key"), F.concat(F.lit("o://"), F.col("o_orderkey").cast("string")).alias("unit"))
    found = o.groupBy("claim_id", "selection_key").agg(F.array_sort(F.collect_set("unit")).alias("units"))
    said = found.select("claim_id", "selection_key", F.when(F.size("units") > 1, F.col("units")).alias("units"), F.when(F.size("units") == 1, "too few").alias("error"))
    back = V.resolved_from(found.select("claim_id", "selection_key"), V.binding_map(said))
    return back.select("claim_id", "selection_key", F.array_join("units", ";").alias("units"))


def pub_policy(s, d):
    return PL.set_policy(table(s, d, "sources").select(F.when(F.col("source") == "co.anilist", "{}").otherwise('{"x":1}').alias("document"), F.col("revision").alias("generation")), '{"x":1}')


def aln_order_violations(s, d):
    rows = table(s, d, "lineitem").select(F.col("l_orderkey").alias("parent"), F.lit(1).alias("season"), F.col("l_linenumber").alias("episode"), F.col("l_partkey").cast("string").alias("reference"))
    return A.order_violations(rows, ("parent",))


def graph_components(s, d):
    p = table(s, d, "part")
    star = lambda *c: p.groupBy(*c).agg(F.min("p_partkey").alias("a"), F.collect_set("p_partkey").alias("m")).select("a", F.explode("m").alias("b"))
    return components(star("p_name", "p_brand", "p_type").union(star("p_brand", "p_type", "p_size"))).select(F.col("node").cast("bigint").alias("node"), F.col("root").cast("bigint").alias("root"))


def shop_edges(s, d):
    """Customers of a nation by segment against its suppliers by balance, both in the proportion of their numbers."""
    c = table(s, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("extent"))
    left = c.select(F.col("c_nationkey").alias("claim_id"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_mktsegment")).alias("ordinal"), "extent", F.concat(F.lit("c://"), F.col("c_nationkey").cast("string"), F.lit("/"), "c_mktsegment").alias("unit"))
    total = left.groupBy("claim_id").agg(F.sum("extent").alias("total"))
    right = total.select("claim_id", F.explode(F.array(F.struct(F.lit(1).alias("ordinal"), F.floor(F.col("total") / 3).alias("extent")), F.struct(F.lit(2).alias("ordinal"), (F.col("total") - F.floor(F.col("total") / 3)).alias("extent")))).alias("x")).select("claim_id", "x.ordinal", "x.extent").where("extent > 0").withColumn("unit", F.concat(F.lit("s://"), F.col("claim_id").cast("string"), F.lit("/"), F.col("ordinal").cast("string")))
    found = A.align_extents(left, right)
    name = lambda rows, p: rows.select("claim_id", F.col("ordinal").alias(f"{p}_ordinal"), F.col("unit").alias(p), F.col("extent").alias(f"{p}_extent"))
    segments = found.join(name(left, "left"), ["claim_id", "left_ordinal"]).join(name(right, "right"), ["claim_id", "right_ordinal"])
    statements = left.select("claim_id").distinct().withColumn("operator", F.lit("<~>"))
    return G.correspondences(statements, segments)


def graph_edges(s, d):
    return shop_edges(s, d)


def graph_cuts(s, d):
    return G.cuts(shop_edges(s, d))


def graph_atoms(s, d):
    return G.atoms(shop_edges(s, d))


def graph_conflict(s, d):
    """The halves of each nation's first supplier unit are said to be one customer segment, which is therefore in it twice."""
    n = table(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("k"))
    half = lambda a, b: n.select(F.concat(F.lit("c://"), "k").alias("left"), F.lit("0/1").alias("left_start"), F.lit("1/1").alias("left_end"), F.concat(F.lit("s://"), "k").alias("right"), F.lit(a).alias("right_start"), F.lit(b).alias("right_end"))
    found = G.conflicts(G.atoms(half("0/1", "1/2").unionByName(half("1/2", "1/1"))))
    return found.select("unit", F.col("times").alias("times"))


def graph_atom_counts(s, d):
    """Pieces and atoms: as many atoms as stretches that two sides share."""
    return G.atoms(shop_edges(s, d)).agg(F.count("*").alias("pieces"), F.count_distinct("atom").alias("atoms"))


def graph_rules(s, d):
    """Unordered coverage of each nation's units as rules between atoms."""
    edges = shop_edges(s, d)
    groups = edges.select("claim_id", F.lit(0).alias("side"), F.col("left").alias("unit")).union(edges.select("claim_id", F.lit(1).alias("side"), F.col("right").alias("unit"))).distinct()
    return G.group_rules(G.atoms(edges), groups)


def graph_implications(s, d):
    edges = shop_edges(s, d)
    return G.implication_rules(G.atoms(edges), edges.select("left", "left_start", "left_end", "right", "right_start", "right_end"))


def num_dense(s, d):
    return numbered(table(s, d, "orders").select("o_orderdate", "o_orderkey"), ("o_orderdate", "o_orderkey")).select("o_orderkey", "number")


def pol_footprint(s, d):
    rows = table(s, d, "lineitem").select(F.lit("part").alias("a_source"), F.concat(F.lit("part://"), F.col("l_partkey").cast("string")).alias("a"), F.when(F.col("l_suppkey") % 2 == 0, "supplier").otherwise("dealer").alias("b_source"), F.concat(F.lit("supplier://"), F.col("l_suppkey").cast("string")).alias("b")).distinct().withColumn("claim_id", F.concat_ws("/", "a", "b"))
    return V.footprint(rows, V.policy_table(s, [("part", "supplier")]))


def pol_targets(s, d):
    return pol_footprint(s, d).groupBy("target_source").agg(F.count("*").alias("edges"), F.count_distinct("origin").alias("origins"))


def pol_conflicts(s, d):
    return V.policy_conflicts(pol_footprint(s, d))


def rev_decisions(s, d):
    actions = F.element_at(F.array(F.lit("accepted"), F.lit("rejected"), F.lit("retracted")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    events = table(s, d, "orders").select(F.col("o_custkey").alias("claim_id"), F.col("o_orderkey").alias("version"), actions.alias("action"))
    return V.decisions(events).select("claim_id", "version", "action")


def pub_byte_budget(s, d):
    rows = table(s, d, "orders").select(F.col("o_orderkey").alias("claim_id"), F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("record"))
    return V.publication_batch(rows, most_bytes=20_000).select("claim_id", "bytes_so_far")


def pub_topn(s, d):
    return L.newest(table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ("o_custkey",), [F.desc("o_orderdate"), F.desc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


def pub_delta(s, d):
    o = table(s, d, "orders")
    state = lambda parity: o.where(F.col("o_orderkey") % 2 == parity).groupBy("o_custkey").agg(F.max("o_orderkey").cast("string").alias("content"))
    return V.delta(state(0), state(1), "o_custkey")


def shop_claims(s, d):
    o = table(s, d, "orders")
    text = F.concat(F.lit("customer://c/"), "o_custkey", F.lit(" <=> orders://o/"), "o_orderkey")
    return o.select(text.alias("statement")).select("statement", claim_id(F.col("statement")).alias("claim_id"))


def pub_shard(s, d):
    return shop_claims(s, d).groupBy(F.substring(V.artifact_path(F.col("claim_id")), 8, 2).alias("shard")).agg(F.count("*").alias("files"))


def pub_artifacts(s, d):
    rows = shop_claims(s, d).select("claim_id", F.concat(F.lit("# checked\n"), "statement", F.lit("\n")).alias("record"), F.lit("accepted").alias("action"), F.lit(None).cast("map<string,string>").alias("bindings"))
    return V.artifacts(rows)


def pub_validate(s, d):
    files = pub_artifacts(s, d).withColumn("content", F.when(F.octet_length("content") % 5 == 0, F.concat("content", F.lit("x"))).otherwise(F.col("content")))
    return files.groupBy(V.checked_artifact("path", "content")["ok"].alias("ok")).agg(F.count("*").alias("files"))


def pub_endpoints(s, d):
    return V.endpoints(shop_claims(s, d)).groupBy("a_source", "b_source").agg(F.count("*").alias("claims"), F.count_distinct("a").alias("lefts"))


def src_update_changes(s, d):
    """Versions of one catalog as update notices, and a notice of season types."""
    v = table(s, d, "record_versions").where("source = 'com.thetvdb'")
    key = clean("key")
    kind, number = F.split_part(key, F.lit(":"), F.lit(1)), F.split_part(key, F.lit(":"), F.lit(2)).cast("bigint")
    updates = v.select(F.concat(kind, F.when(kind == "series", "").otherwise("s")).alias("recordType"), number.alias("recordId"), F.when(F.coalesce("deleted", F.lit(False)), 3).otherwise(1).alias("methodInt"), F.when(kind == "episode", number % 100).alias("seriesId"), F.lit(None).cast("bigint").alias("mergeToId"))
    types = s.createDataFrame([("seasontypes", 1, 2, None, None)], updates.schema)
    series = v.where((kind == "series") & F.coalesce("deleted", F.lit(False))).select(key.alias("key")).distinct()
    return C.update_changes(updates.unionByName(types), series)


def src_show_members(s, d):
    shows = table(s, d, "record_versions").where("source = 'org.themoviedb' AND deleted = false").where(clean("key").startswith("tv:"))
    return C.show_members(shows).select("parent", "key").distinct()


def src_asked_and_found(s, d):
    asked = table(s, d, "customer").select(F.col("c_custkey").alias("id"))
    found = table(s, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("payload"))
    return C.asked_and_found(asked, found).groupBy("state").agg(F.count("*").alias("ids"))


def src_new_or_airing(s, d):
    return C.new_or_airing(table(s, d, "customer").select(F.col("c_custkey").alias("id")), table(s, d, "orders").select(F.col("o_custkey").alias("id")), 1000)


def src_episode_orders(s, d):
    rows = table(s, d, "lineitem").select(F.col("l_orderkey").alias("series"), F.lit("aired").alias("order"), F.col("l_linenumber").alias("page"), F.col("l_partkey").alias("position"), F.col("l_suppkey").alias("id"), F.concat_ws(":", "l_suppkey", "l_returnflag").alias("body"))
    return C.episode_orders(rows).select("series", F.array_join("episodes", ";").alias("episodes"))


QUERIES = {f.__name__: f for f in (sel_domain_rank, sel_units, sel_order_units, sem_violations, sem_evaluate, sem_align_extent, sem_tails, sem_zip, aln_islands, aln_spans, aln_expressions, aln_unique_match, aln_dates, aln_statements, pip_hierarchy, rev_violations, rev_pending, pub_bindings, pub_policy, aln_order_violations, graph_components, graph_edges, graph_cuts, graph_atoms, graph_conflict, graph_atom_counts, graph_rules, graph_implications, num_dense, pol_targets, pol_conflicts, rev_decisions, pub_byte_budget, pub_topn, pub_delta, pub_shard, pub_artifacts, pub_validate, pub_endpoints, src_update_changes, src_show_members, src_asked_and_found, src_new_or_airing, src_episode_orders)}

_LINES = "lines AS (SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) AS bigint) AS extent, max(l_returnflag) AS flag FROM lineitem GROUP BY ALL)"
_SIDES = f"""{_LINES}, l AS (SELECT l_orderkey AS claim_id, l_linenumber AS ordinal, extent, sum(extent) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS e FROM lines),
t AS (SELECT claim_id, sum(extent) AS total FROM l GROUP BY claim_id), r AS (SELECT claim_id, unnest(range(1, greatest(1, total // 10)::bigint + 1)) AS ordinal FROM t)"""
_DOMAIN = "dom AS (SELECT *, row_number() OVER (PARTITION BY entity, dimension ORDER BY try_cast(CASE WHEN regexp_full_match(value, '[0-9]+') THEN value END AS bigint) NULLS LAST, value) AS position FROM (SELECT DISTINCT p_type AS entity, 'size' AS dimension, CAST(p_size AS varchar) AS value FROM part UNION SELECT DISTINCT p_type, 'brand', p_brand FROM part))"
_SPANS = f"""{_LINES}, x AS (SELECT l_orderkey // 4 AS parent, l_orderkey % 4 AS s, l_linenumber AS e FROM lines WHERE flag <> 'R'),
a AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY s, e) AS at_ FROM x), b AS (SELECT *, e - row_number() OVER (PARTITION BY parent, s ORDER BY e) AS g FROM a),
parts AS (SELECT parent, s, min(e) AS e0, max(e) AS e1, min(at_) AS at_ FROM b GROUP BY parent, s, g),
m AS (SELECT *, CASE WHEN s = lag(s) OVER w + 1 AND e0 = lag(e0) OVER w AND e1 = lag(e1) OVER w THEN 0 ELSE 1 END AS brk FROM parts WINDOW w AS (PARTITION BY parent ORDER BY at_)),
n AS (SELECT *, sum(brk) OVER (PARTITION BY parent ORDER BY at_) AS span FROM m),
spans AS (SELECT parent, span, min(s) AS season_start, max(s) AS season_end, min(e0) AS episode_start, max(e1) AS episode_end FROM n GROUP BY parent, span)"""
_FOOT = "f AS (SELECT DISTINCT 'part://' || l_partkey AS a, 'supplier://' || l_suppkey AS b FROM lineitem WHERE l_suppkey % 2 = 0), w AS (SELECT a AS origin, 'supplier' AS target_source, b AS target FROM f UNION ALL SELECT b, 'part', a FROM f)"
_SHOP = """c AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY g) AS ordinal FROM (SELECT c_nationkey AS claim_id, c_mktsegment AS g, count(*) AS extent FROM customer GROUP BY ALL)),
l AS (SELECT *, sum(extent) OVER (PARTITION BY claim_id ORDER BY ordinal) - extent AS s0, sum(extent) OVER (PARTITION BY claim_id ORDER BY ordinal) AS s1 FROM c),
t AS (SELECT claim_id, CAST(sum(extent) AS bigint) AS total FROM c GROUP BY claim_id),
r AS (SELECT claim_id, 1 AS ordinal, total // 3 AS extent, 0 AS s0, total // 3 AS s1 FROM t WHERE total // 3 > 0 UNION ALL SELECT claim_id, 2, total - total // 3, total // 3, total FROM t),
seg AS (SELECT l.claim_id, 'c://' || l.claim_id || '/' || g AS "left", 's://' || l.claim_id || '/' || r.ordinal AS "right", greatest(l.s0, r.s0) AS a, least(l.s1, r.s1) AS b, l.s0 AS ls, l.extent AS le, r.s0 AS rs, r.extent AS re FROM l JOIN r ON l.claim_id = r.claim_id AND l.s0 < r.s1 AND r.s0 < l.s1),
fr AS (SELECT claim_id, "left", "right", CAST(a - ls AS bigint) AS n1, CAST(b - ls AS bigint) AS n2, CAST(le AS bigint) AS le, CAST(a - rs AS bigint) AS n3, CAST(b - rs AS bigint) AS n4, CAST(re AS bigint) AS re, a, b FROM seg)"""
_ATOMS = """pc AS (SELECT claim_id, "left" AS unit, 0 AS side, n1 AS a, n2 AS z, le AS d, claim_id || '|' || "left" || '|' || "right" AS seg, n1 * 1.0 / le AS at_ FROM fr UNION ALL SELECT claim_id, "right", 1, n3, n4, re, claim_id || '|' || "left" || '|' || "right", n3 * 1.0 / re FROM fr),
pp AS (SELECT *, CAST(row_number() OVER (PARTITION BY unit ORDER BY at_) - 1 AS int) AS piece FROM pc),
an AS (SELECT seg, CAST(row_number() OVER (ORDER BY f) - 1 AS int) AS atom FROM (SELECT seg, min((unit, piece)) AS f FROM pp GROUP BY seg))"""
_F = lambda n, d: f"({n} // gcd({n}, {d})) || '/' || ({d} // gcd({n}, {d}))"
SQL = {
    "sel_domain_rank": f"WITH {_DOMAIN} SELECT entity, dimension, value, position FROM dom",
    "sel_units": f"WITH {_DOMAIN} SELECT 'q:' || p_type AS question, 'part://' || p_partkey AS reference FROM part p WHERE p_size BETWEEN 10 AND 30 AND p_brand IN (SELECT value FROM dom WHERE entity = p.p_type AND dimension = 'brand' AND position <= 2) AND EXISTS (SELECT 1 FROM part q WHERE q.p_type = p.p_type AND q.p_size = 10) AND EXISTS (SELECT 1 FROM part q WHERE q.p_type = p.p_type AND q.p_size = 30)",
    "sel_order_units": "SELECT p_brand AS entity, 'part://' || p_partkey AS reference, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size > 10 THEN p_size END NULLS FIRST, 'part://' || p_partkey) AS ordinal FROM part",
    "sem_violations": """SELECT DISTINCT 'c' || l_orderkey AS claim_id, 'Invalid' AS kind, 'unit repeats: part://' || l_partkey AS message FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'c' || l_orderkey, 'Invalid', 'coordinate repeats: ' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "sem_evaluate": """WITH s AS (SELECT o_custkey AS c, o_orderstatus AS st, count(*) AS m, CAST(sum(o_orderkey % 4 + 1) AS bigint) AS t, list_sort(list(o_orderkey % 4 + 1)) AS e FROM orders GROUP BY ALL)
SELECT a.c AS claim_id, CASE WHEN a.c % 3 = 0 AND a.m <> b.m THEN 'Invalid: counts differ' WHEN a.c % 3 = 0 AND NOT p THEN 'Invalid: no common order' WHEN a.c % 3 = 0 AND a.e <> b.e THEN 'Invalid: extents differ' WHEN a.c % 3 = 2 AND NOT p THEN 'Invalid: no common order'
 WHEN a.c % 3 <> 0 AND a.t <> b.t AND (a.c % 5 <> 0 OR NOT p) THEN 'Invalid: totals differ' ELSE 'valid' END AS verdict, p AS positional, a.t - least(a.t, b.t) AS unmapped_left, b.t - least(a.t, b.t) AS unmapped_right
FROM s a JOIN s b ON a.c = b.c AND a.st = 'F' AND b.st = 'O', LATERAL (SELECT a.c % 2 = 0 OR (a.m = 1 AND b.m = 1) AS p)""",
    "sem_align_extent": f"WITH {_SIDES} SELECT l.claim_id, l.ordinal AS left_ordinal, r.ordinal AS right_ordinal, CAST(greatest(e - extent, (r.ordinal - 1) * 10) - (e - extent) AS bigint) AS left_offset, CAST(greatest(e - extent, (r.ordinal - 1) * 10) - (r.ordinal - 1) * 10 AS bigint) AS right_offset, CAST(least(e, r.ordinal * 10) - greatest(e - extent, (r.ordinal - 1) * 10) AS bigint) AS shared FROM l JOIN r ON l.claim_id = r.claim_id AND e - extent < r.ordinal * 10 AND (r.ordinal - 1) * 10 < e",
    "sem_tails": f"WITH {_SIDES}, sh AS (SELECT t.claim_id, least(total, n * 10) AS shared FROM t JOIN (SELECT claim_id, count(*) AS n FROM r GROUP BY claim_id) USING (claim_id)) SELECT claim_id, 'left' AS side, ordinal, CAST(greatest(0, shared - (e - extent)) AS bigint) AS covered, extent FROM l JOIN sh USING (claim_id) WHERE e > shared UNION ALL SELECT claim_id, 'right', ordinal, CAST(greatest(0, shared - (ordinal - 1) * 10) AS bigint), 10 FROM r JOIN sh USING (claim_id) WHERE ordinal * 10 > shared",
    "sem_zip": "WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus AS st, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS n FROM orders) SELECT a.o_custkey AS claim_id, a.o_orderkey AS left_ordinal, b.o_orderkey AS right_ordinal FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.n = b.n AND a.st = 'F' AND b.st = 'O'",
    "aln_islands": f"WITH {_LINES}, g AS (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM lines WHERE flag = 'N') SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS last FROM g GROUP BY l_orderkey, g",
    "aln_spans": f"WITH {_SPANS} SELECT parent, season_start, season_end, episode_start, episode_end FROM spans",
    "aln_expressions": f"""WITH {_SPANS}, y AS (SELECT parent, span, 'shop://order/' || parent || ' :: kind=default,season=' || season_start || CASE WHEN season_end > season_start THEN '..' || season_end ELSE '' END || ',episode=' || episode_start || CASE WHEN episode_end > episode_start THEN '..' || episode_end ELSE '' END AS x FROM spans)
SELECT parent, CASE WHEN count(*) = 1 THEN min(x) ELSE '[' || string_agg(x, ',' ORDER BY span) || ']' END AS expression FROM y GROUP BY parent""",
    "aln_unique_match": """WITH p AS (SELECT *, CASE WHEN p_partkey % 50 = 0 THEN 'r' || (p_partkey % 100 + 1) END AS linked FROM part), l AS (SELECT * FROM p WHERE p_partkey % 2 = 0), r AS (SELECT *, 'r' || p_partkey AS ref FROM p WHERE p_partkey % 2 = 1),
lu AS (SELECT p_name, p_type, p_size, min(p_partkey) AS k FROM l GROUP BY ALL HAVING count(*) = 1), ru AS (SELECT p_name, p_type, p_size, min(ref) AS ref FROM r GROUP BY ALL HAVING count(*) = 1),
m AS (SELECT 'l' || l.p_partkey AS a, ref AS b FROM l JOIN r ON l.linked = r.ref UNION ALL SELECT 'l' || l.p_partkey, ru.ref FROM l JOIN lu ON lu.k = l.p_partkey JOIN ru ON ru.p_name = l.p_name AND ru.p_type = l.p_type AND ru.p_size = l.p_size WHERE l.linked IS NULL)
SELECT min(a) AS left_reference, b AS right_reference FROM m GROUP BY b HAVING count(*) = 1""",
    "aln_dates": r"SELECT episode_id, day FROM (SELECT episode_id, max(coalesce(air_date, '')) AS t FROM episodes GROUP BY episode_id), LATERAL (SELECT CAST(try_strptime(CASE WHEN regexp_full_match(t, '\d{1,4}-\d{1,2}-\d{1,2}') THEN t END, '%Y-%m-%d') AS date) AS day) WHERE day IS NOT NULL",
    "rev_violations": """WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 < 5)
SELECT 'c' || k AS claim_id, 'a note is needed' AS message FROM o WHERE k % 3 = 0
UNION ALL SELECT 'c' || k, 'another decision came first' FROM o WHERE k % 4 > 0 AND k % 7 = 0
UNION ALL SELECT 'c' || k, 'the candidate changed' FROM o WHERE k % 5 > 0 AND k % 3 = 1
UNION ALL SELECT 'c' || k, 'no current evidence' FROM o WHERE k % 2 = 0 AND k % 3 <> 1 AND k % 6 = 0
UNION ALL SELECT 'c' || k, 'the statement is invalid' FROM o WHERE k % 2 = 0 AND k % 11 = 0
UNION ALL SELECT 'c' || k, 'the policy excludes it' FROM o WHERE k % 2 = 0 AND k % 13 = 0""",
    "rev_pending": """WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders), q AS (SELECT * FROM o WHERE k % 50 = 0 AND k <= 40000),
a AS (SELECT 0 AS turn, 'c' || (k + 1) AS claim_id, 'r' || (k + 1) AS record, 'rejected' AS action FROM q WHERE k % 100 <> 0 AND k + 1 IN (SELECT k FROM o) UNION ALL SELECT 1, 'c' || k, 'n' || k, CASE WHEN k % 100 = 0 THEN 'retracted' ELSE 'accepted' END FROM q)
SELECT claim_id, (SELECT max(k) FROM o) + row_number() OVER (ORDER BY turn, claim_id, action) AS generation, record, action, CASE action WHEN 'retracted' THEN 'delete' ELSE 'write' END AS file FROM a""",
    "pub_bindings": "SELECT 'c' || o_custkey AS claim_id, 'o://' || o_orderstatus || ' :: **' AS selection_key, CASE WHEN count(*) > 1 THEN string_agg('o://' || o_orderkey, ';' ORDER BY 'o://' || o_orderkey) END AS units FROM orders GROUP BY o_custkey, o_orderstatus",
    "pub_policy": """SELECT '{"x":1}' AS document, revision + CASE WHEN source = 'co.anilist' THEN 1 ELSE 0 END AS generation FROM sources""",
    "aln_order_violations": "SELECT l_orderkey AS parent, '1x' || l_linenumber AS what, 'ambiguous coordinates' AS message FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 UNION ALL SELECT l_orderkey, CAST(l_partkey AS varchar), 'repeated episode' FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1",
    "graph_components": """WITH RECURSIVE e AS (SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_brand = b.p_brand AND (a.p_name = b.p_name OR a.p_size = b.p_size)),
w AS (SELECT p_partkey AS node, p_partkey AS other FROM part UNION SELECT w.node, e.b FROM w JOIN e ON e.a = w.other) SELECT node, min(other) AS root FROM w GROUP BY node""",
    "graph_edges": f"""WITH {_SHOP} SELECT claim_id, '<~>' AS operator, "left", {_F('n1', 'le')} AS left_start, {_F('n2', 'le')} AS left_end, "right", {_F('n3', 're')} AS right_start, {_F('n4', 're')} AS right_end FROM fr""",
    "graph_cuts": f"""WITH {_SHOP} SELECT DISTINCT unit, place FROM (SELECT "left" AS unit, unnest([{_F('n1', 'le')}, {_F('n2', 'le')}, '0/1', '1/1']) AS place FROM fr UNION ALL SELECT "right", unnest([{_F('n3', 're')}, {_F('n4', 're')}, '0/1', '1/1']) FROM fr)""",
    "graph_conflict": "SELECT 's://' || n_nationkey AS unit, 2 AS times FROM nation",
    "graph_atoms": f"""WITH {_SHOP}, {_ATOMS} SELECT unit, piece, {_F('a', 'd')} AS "start", {_F('z', 'd')} AS "end", atom FROM pp JOIN an USING (seg)""",
    "graph_rules": f"WITH {_SHOP}, {_ATOMS} SELECT DISTINCT list_sort(list(DISTINCT atom)) AS antecedent, list_sort(list(DISTINCT atom)) AS consequent FROM pp JOIN an USING (seg) GROUP BY claim_id",
    "graph_implications": f"WITH {_SHOP}, {_ATOMS} SELECT DISTINCT [atom] AS antecedent, [atom] AS consequent FROM an",
    "aln_statements": """WITH o AS (SELECT o_custkey AS parent, o_orderkey AS k, year(o_orderdate) AS s, o_orderstatus <> 'P' AS both_, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS e FROM orders),
l AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY s, e) AS la FROM o), r AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY s, e) AS ra FROM l WHERE both_),
b AS (SELECT *, CASE WHEN la = lag(la) OVER w + 1 AND ra = lag(ra) OVER w + 1 AND ((s = lag(s) OVER w AND e = lag(e) OVER w + 1) OR s > lag(s) OVER w) THEN 0 ELSE 1 END AS brk FROM r WINDOW w AS (PARTITION BY parent ORDER BY la)),
n AS (SELECT *, sum(brk) OVER (PARTITION BY parent ORDER BY la) AS run FROM b),
p AS (SELECT parent, run, s, min(e) AS e0, max(e) AS e1, min(la) AS la FROM (SELECT *, e - row_number() OVER (PARTITION BY parent, run, s ORDER BY e) AS g FROM n) GROUP BY parent, run, s, g),
m AS (SELECT *, CASE WHEN s = lag(s) OVER w + 1 AND e0 = lag(e0) OVER w AND e1 = lag(e1) OVER w THEN 0 ELSE 1 END AS brk FROM p WINDOW w AS (PARTITION BY parent, run ORDER BY la)),
q AS (SELECT *, sum(brk) OVER (PARTITION BY parent, run ORDER BY la) AS span FROM m),
y AS (SELECT parent, run, span, ' :: season=' || min(s) || CASE WHEN max(s) > min(s) THEN '..' || max(s) ELSE '' END || ',episode=' || min(e0) || CASE WHEN max(e1) > min(e0) THEN '..' || max(e1) ELSE '' END AS x FROM q GROUP BY parent, run, span),
z AS (SELECT parent, run, count(*) AS n, string_agg('shop://c/' || parent || x, ',' ORDER BY span) AS a, string_agg('shop://c/' || parent || '/b' || x, ',' ORDER BY span) AS b FROM y GROUP BY parent, run)
SELECT parent, CAST(run AS bigint) AS run, CASE WHEN n = 1 THEN a || ' <=> ' || b ELSE '[' || a || '] <=> [' || b || ']' END AS statement FROM z""",
    "graph_atom_counts": f"WITH {_SHOP} SELECT 2 * count(*) AS pieces, count(*) AS atoms FROM fr",
    "num_dense": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS number FROM orders",
    "pol_targets": f"WITH {_FOOT} SELECT target_source, count(*) AS edges, count(DISTINCT origin) AS origins FROM w GROUP BY target_source",
    "pol_conflicts": f"WITH {_FOOT} SELECT origin, target_source, count(DISTINCT target) AS targets FROM w GROUP BY ALL HAVING count(DISTINCT target) > 1",
    "rev_decisions": "SELECT claim_id, version, action FROM (SELECT o_custkey AS claim_id, max(o_orderkey) AS version, ['accepted', 'rejected', 'retracted'][max(o_orderkey) % 3 + 1] AS action FROM orders GROUP BY o_custkey) WHERE action <> 'retracted'",
    "pub_byte_budget": "SELECT claim_id, b AS bytes_so_far FROM (SELECT o_orderkey AS claim_id, CAST(sum(strlen(o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || o_orderpriority)) OVER (ORDER BY o_orderkey) AS bigint) AS b, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 999 AND b <= 20000",
    "pub_topn": "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n <= 3",
    "pub_delta": "WITH a AS (SELECT o_custkey, CAST(max(o_orderkey) AS varchar) AS x FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey, CAST(max(o_orderkey) AS varchar) AS x FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1) SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN a.x IS NULL THEN 'added' WHEN b.x IS NULL THEN 'deleted' ELSE 'changed' END AS change, b.x AS content FROM a FULL JOIN b USING (o_custkey) WHERE a.x IS DISTINCT FROM b.x",
    "pub_shard": "SELECT substr(sha256('catenary-claim:v1' || chr(0) || 'customer://c/' || o_custkey || ' <=> orders://o/' || o_orderkey), 1, 2) AS shard, count(*) AS files FROM orders GROUP BY 1",
    "pub_artifacts": "WITH c AS (SELECT 'customer://c/' || o_custkey || ' <=> orders://o/' || o_orderkey AS t, sha256('catenary-claim:v1' || chr(0) || 'customer://c/' || o_custkey || ' <=> orders://o/' || o_orderkey) AS h FROM orders) SELECT 'claims/' || substr(h, 1, 2) || '/' || h || '.trk' AS path, '# checked' || chr(10) || '#@decision accepted' || chr(10) || t || chr(10) AS content FROM c",
    "pub_validate": "SELECT strlen('# checked' || chr(10) || '#@decision accepted' || chr(10) || 'customer://c/' || o_custkey || ' <=> orders://o/' || o_orderkey || chr(10)) % 5 <> 0 AS ok, count(*) AS files FROM orders GROUP BY 1",
    "src_show_members": r"""WITH v AS (SELECT CASE WHEN json_type(payload) = 'VARCHAR' THEN payload::json->>'$' ELSE payload END AS p FROM record_versions
  WHERE source = 'org.themoviedb' AND deleted = false AND payload IS NOT NULL AND starts_with(lower(regexp_replace(key, '^\s+|\s+$', '', 'g')), 'tv:')),
b AS (SELECT CASE WHEN p->>'$.status' IS NOT NULL AND json_type(p, '$.data') = 'OBJECT' THEN p->>'$.data' ELSE p END AS p FROM v),
r AS (SELECT 'tv:' || (p->>'$.id') AS parent, p->'$.seasons' AS s, p->'$.episode_groups.results' AS g FROM b),
s AS (SELECT parent, unnest(CASE json_type(s) WHEN 'ARRAY' THEN s::json[] WHEN 'OBJECT' THEN [s] ELSE [] END) AS s FROM r),
e AS (SELECT parent, unnest(CASE json_type(s, '$.episodes') WHEN 'ARRAY' THEN (s->'$.episodes')::json[] WHEN 'OBJECT' THEN [s->'$.episodes'] ELSE [] END) AS e FROM s WHERE s->>'$.id' IS NOT NULL),
g AS (SELECT parent, unnest(CASE json_type(g) WHEN 'ARRAY' THEN g::json[] WHEN 'OBJECT' THEN [g] ELSE [] END) AS g FROM r)
SELECT parent, 'season:' || (s->>'$.id') AS key FROM s WHERE s->>'$.id' IS NOT NULL UNION SELECT parent, 'episode:' || (e->>'$.id') FROM e WHERE e->>'$.id' IS NOT NULL UNION SELECT parent, 'episode_group:' || (g->>'$.id') FROM g WHERE g->>'$.id' IS NOT NULL""",
    "pub_endpoints": "SELECT 'customer' AS a_source, 'orders' AS b_source, count(*) AS claims, count(DISTINCT o_custkey) AS lefts FROM orders",
    "src_update_changes": r"""WITH v AS (SELECT split_part(k, ':', 1) AS kind, CAST(split_part(k, ':', 2) AS bigint) AS n, coalesce(deleted, false) AS del FROM (SELECT lower(regexp_replace(key, '^\s+|\s+$', '', 'g')) AS k, deleted FROM record_versions WHERE source = 'com.thetvdb')),
c AS (SELECT kind || ':' || n AS key, CASE WHEN del THEN 'deleted' ELSE 'dirty' END AS action FROM v UNION ALL SELECT 'series:' || (n % 100), 'dirty' FROM v WHERE kind = 'episode' UNION ALL SELECT 'series:' || n, 'dirty' FROM v WHERE kind = 'series' AND del) SELECT key, max(action) AS action FROM c GROUP BY key""",
    "src_asked_and_found": "WITH f AS (SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY 1) SELECT CASE WHEN c_custkey IS NULL THEN 'not asked for' WHEN n > 1 THEN 'answered twice' WHEN n IS NULL THEN 'absent' ELSE 'found' END AS state, count(*) AS ids FROM customer FULL JOIN f ON c_custkey = id GROUP BY 1",
    "src_new_or_airing": "SELECT c_custkey AS id FROM customer WHERE c_custkey > 1000 UNION SELECT o_custkey FROM orders",
    "src_episode_orders": "WITH k AS (SELECT l_orderkey AS series, l_suppkey, min((l_linenumber, l_partkey)) AS at_, min(l_suppkey || ':' || l_returnflag) AS body FROM lineitem GROUP BY ALL HAVING min(l_returnflag) = max(l_returnflag)) SELECT series, string_agg(body, ';' ORDER BY at_, body) AS episodes FROM k GROUP BY series",
}
