"""Registered queries of training: first steps in full, which SQL can follow, and whole fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from terraloom.operators import boosting as T
from terraloom.operators import embeddings as E
from terraloom.operators import regression as R
from terraloom.operators.features import Scaler
from terraloom.registry import graphs as G
from terraloom.registry.base import query, round6
from terraloom.registry.bindings import sql
from terraloom.registry.tables import municipal, rounded
from terraloom.session import materialise

# --- boosting: the first tree -------------------------------------------------------------------------

_NUMERIC = ["total_contracts", "income_per_capita", "any"]
_BOUNDS = [[20.0, 40.0, 60.0, 80.0, 100.0, 150.0, 200.0], [5e4 * i for i in range(1, 9)], [1995.0 + i for i in range(7)]]
_LAST_FITTED = 2000


def _bin(column: str, bounds: list[float]) -> str:
    return f"case when {column} is null then 255 else len(list_filter({bounds}, lambda b: b < {column})) end"


_VIEWS = {
    "base": 'select municipality_id, "any" yr, round(avg_monthly_rent, 6) y, total_contracts tc, income_per_capita ic, comarca_name cn from municipal where avg_monthly_rent is not null',
    "fitted": f"select * from base where yr <= {_LAST_FITTED}",
    "first": "select median(y) s from fitted",
    "cats": "select cn, row_number() over (order by cn) - 1 code from (select distinct cn from fitted where cn is not null)",
    "coded": f"""select municipality_id, yr, y, s, {_bin('tc', _BOUNDS[0])} f0, {_bin('ic', _BOUNDS[1])} f1, {_bin('yr', _BOUNDS[2])} f2, coalesce(code, 255) f3
      from base left join cats using (cn), first""",
    "bins": """select f, cast(b as int) b, cast(sum(sign(s - y)) as double) g, cast(count(*) as double) n from (
      select 0 f, f0 b, s, y, yr from coded union all select 1, f1, s, y, yr from coded union all select 2, f2, s, y, yr from coded union all select 3, f3, s, y, yr from coded)
      where yr <= """ + str(_LAST_FITTED) + " group by f, b",
    "placed": "select *, case when f < 3 then b else row_number() over (partition by f order by g / (n + 10), b) - 1 end k from bins where b < 255",
    "running": "select f, k, sum(g) over w g, sum(n) over w n from placed window w as (partition by f order by k)",
    "gaps": "select f, g, n from bins where b = 255",
    "whole": "select sum(g) gt, sum(n) nt from bins where f = 0",
    "tries": """select f, k, 0 ml, g, n, case when f = 3 then 10.0 else 0.0 end p from running
      union all select f, k, 1, r.g + m.g, r.n + m.n, 0.0 from running r join gaps m using (f) where f < 3""",
    "gained": """select f, k, ml, g * g / (n + p) + (gt - g) * (gt - g) / (nt - n + p) - gt * gt / nt gain from tries, whole where n >= 20 and nt - n >= 20""",
    "split": "select * from gained order by gain desc, f, ml, k limit 1",
    "sided": """select municipality_id, yr, y, s, coalesce(case when c.b = 255 then ml = 1 when split.f < 3 then c.b <= split.k else p.k <= split.k end, false) l
      from (select municipality_id, yr, y, s, case split.f when 0 then f0 when 1 then f1 when 2 then f2 else f3 end b from coded, split) c cross join split
      left join placed p on p.f = split.f and p.b = c.b""",
    "leaves": f"select l, median(y - s) m from sided where yr <= {_LAST_FITTED} group by l",
}


def _rows(spark, sf):
    """Annual rows with a rent, which :func:`municipal` gives to six digits, as does the SQL."""
    return municipal(spark, sf).select("municipality_id", *_NUMERIC, "comarca_name", "avg_monthly_rent").where("avg_monthly_rent is not null")


def _blocks(spark, sf):
    rows = _rows(spark, sf)
    fitted = F.col("any") <= _LAST_FITTED
    binning = T.Binning(_BOUNDS, T.fit_binning(rows.where(fitted), [], ["comarca_name"]).categories)
    return rows, binning, T.make_blocks(rows, binning, _NUMERIC, ["comarca_name"], "avg_monthly_rent", F.when(fitted, 0).otherwise(1))


def _stump(spark, sf) -> tuple:
    """A tree of one split over all fitted rows, unscaled."""
    rows, binning, blocks = _blocks(spark, sf)
    whole = T.Settings(leaves=2, rate=1.0, rows=1.0, columns=1.0)
    booster = T.boost(blocks, binning, whole, 1)
    return rows, R.RentModel(booster, _NUMERIC, ["comarca_name"], [], Scaler({}), 1)


@query("boosting_histogram", sql("select f feature, b bin, round(g, 6) gradient, cast(n as bigint) \"rows\" from bins", "municipal",
                                 **{k: _VIEWS[k] for k in ("base", "fitted", "first", "cats", "coded", "bins")}))
def _(spark, sf):
    """Sums of gradients by feature and bin before the first tree."""
    _, binning, blocks = _blocks(spark, sf)
    start = T.boost(blocks, binning, T.Settings(), 0).start
    return T.first_histograms(blocks, binning, start).withColumn("gradient", round6("gradient"))


@query("boosting_first_split", sql("""select round(s, 6) "start", split.f feature, round(gain, 6) gain, round(max(m) filter (l), 6) left_median, round(max(m) filter (not l), 6) right_median
  from first, split, leaves group by all""", "municipal", **_VIEWS))
def _(spark, sf):
    """The first split by gain, and the exact medians of both sides' residuals."""
    _, model = _stump(spark, sf)
    tree = model.booster.trees[0]
    left, right = tree.children[0]
    row = (float(model.booster.start), int(tree.feature[0]), float(tree.gain[0]), float(tree.value[left]), float(tree.value[right]))
    return rounded(spark.createDataFrame([row], "start double, feature int, gain double, left_median double, right_median double"),
                   "start", "gain", "left_median", "right_median")


@query("boosting_metrics", sql("""select round(1-sum(e*e)/(var_pop(y)*count(*)),6) r2, round(avg(abs(e)),6) mae, round(sum(e*e)/count(*),4) mse, round(sqrt(sum(e*e)/count(*)),6) rmse,
  round(avg(abs(e)/abs(y)),6) mape from (select y, y - s - m e from sided join leaves using (l) where yr > """ + str(_LAST_FITTED) + ")", "municipal", **_VIEWS))
def _(spark, sf):
    """Metrics of the one-split model over later years, from its stored predictions."""
    rows, model = _stump(spark, sf)
    scored, _ = R.evaluate(model, rows.withColumn("split", F.when(F.col("any") > _LAST_FITTED, "test").otherwise("train")))
    stored = materialise(scored.select("municipality_id", "any", "avg_monthly_rent", "prediction"), "predictions")
    return rounded(R.regression_metrics(stored, "avg_monthly_rent", "prediction"), "r2", "mae", "rmse", "mape").withColumn("mse", F.round("mse", 4))


@query("boosting_importances", sql("""select n.feature, round(case when n.f = split.f then gain else 0 end, 6) importance
  from split, (values (0, 'total_contracts'), (1, 'income_per_capita'), (2, 'any'), (3, 'comarca_name')) n(f, feature)""", "municipal", **_VIEWS))
def _(spark, sf):
    """Gains of the one-split model by feature."""
    _, model = _stump(spark, sf)
    return rounded(R.top_importances(spark, model, 4), "importance")


# --- embeddings: scores of all models, one whole step -----------------------------------------------------

def _sum(term: str, last: int = 64) -> str:
    return f"list_sum([{term} for i in range(1, {last + 1})])"


def _total(term: str, last: int) -> str:
    return f"list_sum([{term} for j in range(1, {last + 1})])"


_ENDS = "from links l join embeddings a on a.vec_id=l.h join embeddings b on b.vec_id=l.t join rels r on r.p=l.p"
_H, _T = "a.embedding[{0}]::double", "b.embedding[{0}]::double"
_HI, _TI = _H.format("i"), _T.format("i")
_FAR_H, _FAR_T = _H.format("i+32"), _T.format("i+32")
_TURNED = (f"({_HI}*cos(r.vec[i])-{_FAR_H}*sin(r.vec[i])-{_TI})", f"({_HI}*sin(r.vec[i])+{_FAR_H}*cos(r.vec[i])-{_FAR_T})")
_MATRIX = _total("r.vec[(i-1)*8+j]*({}-{})".format(_H.format("j"), _T.format("j")), 8)
_ALONG = _total("r.vec[j]*({}-{})".format(_H.format("j"), _T.format("j")), 64)
#: Model -> entity, relation and second relation vectors as lengths, and the score in SQL over given vectors.
_SCORES = {
    "TransH": (64, 64, 64, f"-sqrt({_sum(f'({_HI}-{_TI}-{_ALONG}*r.vec[i]+r.vec[i])**2')})"),
    "TransR": (8, 8, 64, f"-sqrt({_sum(f'({_MATRIX}+r.vec[i])**2', 8)})"),
    "RotatE": (64, 32, 0, f"-sqrt({_sum(f'{_TURNED[0]}**2+{_TURNED[1]}**2', 32)})"),
    "ComplEx": (64, 64, 0, _sum(f"({_HI}*r.vec[i]-{_FAR_H}*r.vec[i+32])*{_TI}+({_FAR_H}*r.vec[i]+{_HI}*r.vec[i+32])*{_FAR_T}", 32)),
}


def _score_query(model: str) -> None:
    entity, relation, extra, score = _SCORES[model]
    @query(f"score_{model.lower()}", sql(f"select h, l.p, t, round({score}, 6) score {_ENDS}", links=G._LINKS, rels=G._RELS))
    def _(spark, sf):
        cut = lambda c, n: F.slice(c, 1, n)
        return G._scored(spark, sf, lambda df: E.score_triples(
            df.select("s", "p", "o", cut("hv", entity).alias("hv"), cut("tv", entity).alias("tv"), cut("rv", relation).alias("rv"), F.col("rv").alias("xv")),
            model, x="xv" if extra else None))


for _model in _SCORES:
    _score_query(_model)

_STEP = {
    "links": "select h, case p when 'A' then 0 when 'N' then 1 else 2 end r, t from (" + G._LINKS + ")",
    "rels": "select case p when 'A' then 0 when 'N' then 1 else 2 end r, vec from (" + G._RELS + ")",
    "ids": "select vec_id, row_number() over (order by vec_id) - 1 i, [x::double for x in embedding] v from embeddings",
    "named": "select a.i h, l.r, b.i t, cast('0x' || left(md5(concat_ws('|', a.i, l.r, b.i, 42, 0)), 13) as bigint) d from links l join ids a on a.vec_id=l.h join ids b on b.vec_id=l.t",
    "drawn": "select h, r, t, d % 2 = 0 head, (d >> 1) % (select count(*) from ids) n from named",
    "pairs": "select *, case when head then n else h end h2, case when head then t else n end t2 from drawn",
    "gaps": """select q.*, [x[1]+x[2]-x[3] for x in list_zip(a.v, rels.vec, b.v)] g, [x[1]+x[2]-x[3] for x in list_zip(c.v, rels.vec, e.v)] g2 from pairs q
      join rels using (r) join ids a on a.i=q.h join ids b on b.i=q.t join ids c on c.i=q.h2 join ids e on e.i=q.t2""",
    "active": """select h, r, t, h2, t2, [x/n1 for x in g] u, [x/n2 for x in g2] w from (select *, sqrt(list_sum([x*x for x in g])) n1, sqrt(list_sum([x*x for x in g2])) n2 from gaps)
      where 1 + n1 - n2 > 0""",
    "moves": """select 'e' kind, h id, u m from active union all select 'e', t, [-x for x in u] from active union all select 'e', h2, [-x for x in w] from active
      union all select 'e', t2, w from active union all select 'r', r, [x[1]-x[2] for x in list_zip(u, w)] from active""",
    "summed": "select kind, id, j, sum(m[j]) g from moves cross join (select unnest(range(1, 65)) j) group by kind, id, j",
    "old": "select 'e' kind, i id, j, v[j] x from ids cross join (select unnest(range(1, 65)) j) union all select 'r', r, j, vec[j] from rels cross join (select unnest(range(1, 65)) j)",
    "lengths": "select kind, id, sqrt(sum(g*g)) len from summed group by kind, id",
    "moved": "select kind, id, j, x - coalesce(g * 0.1 / greatest(1.0, len), 0.0) x from old left join summed using (kind, id, j) left join lengths using (kind, id)",
    "sized": "select kind, id, sqrt(sum(x*x)) size from moved where kind='e' group by kind, id",
}


@query("training_step", sql("select kind, id, j, round(x / coalesce(size, 1.0), 6) \"value\" from moved left join sized using (kind, id)", **_STEP))
def _(spark, sf):
    """All vectors after one step over all links, from the given vectors, with negatives drawn by MD5."""
    params = G._params(spark, sf)
    ids = E.dense_ids(params.where("kind = 'e'"), "id", "i")
    relation = F.when(F.col("p") == "A", 0).when(F.col("p") == "N", 1).otherwise(2).cast("long")
    entities = params.where("kind = 'e'").join(ids, "id").select("kind", F.col("i").alias("id"), "label", "vec")
    relations = params.where("kind = 'r'").withColumn("p", F.col("label")).select("kind", relation.alias("id"), "label", "vec")
    key = lambda name, out: ids.select(F.col("id").cast("string").alias(name), F.col("i").alias(out))
    triples = G._vector_links(spark, sf).join(key("s", "h"), "s").join(key("o", "t"), "o").select("h", relation.alias("r"), "t")
    given = materialise(entities.unionByName(relations), "given")
    sizes = {"e": entities.count(), "r": 3}
    out, _ = E.train_epoch(given, materialise(triples, "triples"), "TransE", 64, 0, sizes)
    return out.select("kind", "id", F.posexplode("vec").alias("j", "value")).select("kind", "id", (F.col("j") + 1).cast("long").alias("j"), round6("value").alias("value"))
