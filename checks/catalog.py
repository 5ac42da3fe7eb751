"""The registered queries: a Spark job over the retailer's tables and its SQL counterpart.

Each entry gives its output columns with a type letter, and both sides are cast to it:
``i`` whole number, ``d`` double, ``s`` text, ``b`` boolean, ``t`` date or time as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.functions import amounts, casts, dates, text
from bazaarlake.operators import calendar as cal
from bazaarlake.operators import quality
from bazaarlake.operators.dedup import duplicate_keys
from bazaarlake.operators.joins import matched_rows, orphan_rows
from bazaarlake.operators.keys import dense_keys, extend_keys
from bazaarlake.operators.references import audit_links
from bazaarlake.operators.sampling import fixed_size_sample
from bazaarlake.plans import dashboard, insights, reconcile, reports, source_model, views, warehouse
from bazaarlake.session import apply_settings
from bazaarlake.sources.events import event_stream, route_by_type, write_event_lines
from bazaarlake.sources.files import volumes
from bazaarlake.sources.sql import register_tables, register_views, run_query
from bazaarlake.sources.tables import in_turn
from bazaarlake.streaming.events import judged, nest_sales, parse, return_events, return_rows, sale_rows
from bazaarlake.streaming.jobs import start_event_ingest, wait
from checks import faults, written
from checks.landing import Retailer
from checks.oracle import big, dbl, half_up, pct, query

SPARK_TYPES = {"i": "bigint", "d": "double", "s": "string", "b": "boolean", "t": "string"}
SQL_TYPES = {"i": "bigint", "d": "double", "s": "varchar", "b": "boolean", "t": "varchar"}


@dataclass(frozen=True)
class Check:
    run: Callable[[Retailer], DataFrame]
    columns: str
    sql: str | None = None

    @property
    def types(self) -> dict[str, str]:
        pairs = [c.rsplit(":", 1) for c in self.columns.split("; ")]
        return {name: kind for name, kind in pairs}

    def spark(self, spark: SparkSession, folder: str) -> DataFrame:
        frame = self.run(Retailer(apply_settings(spark), folder))
        return frame.select(
            *[F.col(f"`{n}`").cast(SPARK_TYPES[k]).alias(n) for n, k in self.types.items()]
        )

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts_ = ", ".join(f'cast("{n}" as {SQL_TYPES[k]}) as "{n}"' for n, k in self.types.items())
        return query(f"select {casts_} from ({self.sql}) as result")


CHECKS: dict[str, Check] = {}


def check(name: str, columns: str, sql: str | None = None):
    def register(run: Callable[[Retailer], DataFrame]):
        CHECKS[name] = Check(run, columns, sql)
        return run

    return register


_LETTER = {"text": "s", "int": "i", "money": "d", "percent": "d", "date": "t", "timestamp": "t", "flag": "b"}


def columns_of(table: contract.Table, but: tuple[str, ...] = (), plus: str = "") -> str:
    own = "; ".join(f"{c.name}:{_LETTER[c.kind]}" for c in table.columns if c.name not in but)
    return f"{plus}; {own}" if plus else own


# --- silver and gold tables --------------------------------------------------------------

_SILVER_SQL = {
    "dim_magasin": "store",
    "dim_fournisseur": "vendor",
    "dim_produit": "item",
    "dim_client": "buyer",
    "dim_temps": "cal_fr",
    "fait_stock": "silver_stock",
    "fait_commandes": "silver_orders",
    "fait_lignes_commandes": "silver_lines",
    "fait_ventes": "silver_sales",
    "fait_retours": "silver_returns",
}
for _name, _cte in _SILVER_SQL.items():
    check(f"clean_{_name}", columns_of(contract.TABLES[_name]), f"select * from {_cte}")(
        lambda r, n=_name: r.silver[n]
    )

check("gold_dim_magasin", columns_of(contract.STORES, plus="magasin_sk:i"), "select * from store")(
    lambda r: r.gold["dim_magasin"]
)
check("gold_dim_fournisseur", columns_of(contract.SUPPLIERS, plus="fournisseur_sk:i"), "select * from vendor")(
    lambda r: r.gold["dim_fournisseur"]
)
check(
    "gold_dim_produit",
    columns_of(contract.PRODUCTS, but=("fournisseur_nk",), plus="produit_sk:i; fournisseur_sk:i"),
    "select * from item",
)(lambda r: r.gold["dim_produit"])
check("gold_dim_client", columns_of(contract.CUSTOMERS, plus="client_sk:i"), "select * from buyer")(
    lambda r: r.gold["dim_client"]
)
check("gold_dim_temps", columns_of(contract.CALENDAR), "select * from cal")(lambda r: r.gold["dim_temps"])

_KEY = "cast(row_number() over (order by substr(md5(concat_ws('|', {0})), 1, 3), {0}) as bigint)"
_DAY = "year({0}) * 10000 + month({0}) * 100 + day({0})"

check(
    "gold_fait_stock",
    "stock_sk:i; date_snapshot_sk:i; produit_sk:i; magasin_sk:i; quantite_en_stock:i; valeur_stock_ht:d; "
    "seuil_reapprovisionnement:i; en_rupture:b",
    f"select {_KEY.format('date_snapshot_sk, produit_sk, magasin_sk')} stock_sk, * from "
    f"(select *, {_DAY.format('date_snapshot')} date_snapshot_sk from gold_stock) x",
)(lambda r: written.numbered(r, "fait_stock"))
check(
    "gold_fait_commandes",
    "commande_sk:i; commande_nk:s; fournisseur_sk:i; magasin_sk:i; date_commande_sk:i; date_livraison_prev_sk:i; "
    "statut:s; montant_total_ht:d",
    f"select *, {_DAY.format('date_commande')} date_commande_sk, "
    f"{_DAY.format('date_livraison_prev')} date_livraison_prev_sk from gold_orders",
)(lambda r: r.gold["fait_commandes"])
check(
    "gold_fait_lignes_commandes",
    "ligne_commande_sk:i; commande_sk:i; produit_sk:i; quantite_commandee:i; prix_unitaire_achat:d; montant_ligne_ht:d",
    f"select {_KEY.format('commande_sk, produit_sk')} ligne_commande_sk, * from "
    "(select * from silver_lines join gold_orders using (commande_nk) join item using (produit_nk)) x",
)(lambda r: written.numbered(r, "fait_lignes_commandes"))
check(
    "gold_fait_ventes",
    "vente_sk:i; ticket_nk:s; timestamp_vente:t; date_sk:i; magasin_sk:i; client_sk:i; produit_sk:i; quantite:i; "
    "prix_unitaire_ht:d; tva_pct:d; prix_unitaire_ttc:d; montant_ht:d; montant_ttc:d; marge_brute_unit:d; "
    "marge_brute_total:d",
    f"select {_KEY.format('ticket_nk, produit_sk')} vente_sk, * from gold_sales",
)(lambda r: written.numbered(r, "fait_ventes"))
check(
    "gold_fait_retours",
    "retour_sk:i; retour_nk:s; ticket_nk:s; produit_sk:i; magasin_sk:i; client_sk:i; date_vente_originale_sk:i; "
    "date_retour_sk:i; quantite_retournee:i; montant_rembourse:d; motif:s",
    f"select {_KEY.format('retour_nk')} retour_sk, *, {_DAY.format('date_vente_originale')} date_vente_originale_sk, "
    f"{_DAY.format('date_retour')} date_retour_sk from gold_returns",
)(lambda r: written.numbered(r, "fait_retours"))
_LINE_TABLES = {"fait_stock": "gold_stock", "fait_ventes": "gold_sales", "fait_retours": "gold_returns",
                "fait_lignes_commandes": "(select * from silver_lines join gold_orders using (commande_nk) join item using (produit_nk))"}
check(
    "line_keys",
    "table_name:s; nb_lignes:i; sk_min:i; sk_max:i; nb_sk:i",
    " union all ".join(
        f"select '{t}' table_name, count(*) nb_lignes, 1 sk_min, count(*) sk_max, count(*) nb_sk from {rows} q" for t, rows in _LINE_TABLES.items()
    ),
)(lambda r: written.key_facts(written.built(r)))

# --- landing, casts, quality ----------------------------------------------------------------


@check(
    "bronze_ventes",
    columns_of(contract.SALES, but=("timestamp_vente",)),
    "select * from landed_sales",
)
def _(r):
    """The landed text read back by its contract, before any rule."""
    landed = r.bronze["fait_ventes"]
    return landed.select(*[casts.read_as(c).alias(c.name) for c in contract.SALES.columns])


@check(
    "rejects_summary",
    "table_name:s; reason:s; rule_id:s; nb_rejets:i",
    f"""select 'fait_ventes' table_name, case when rule_id = 'client_nk_orphan' then 'client_nk fantome inexistant'
      else '{contract.REJECT_REASONS["fait_ventes"]}' end reason, rule_id, count(*) nb_rejets
    from judged_sales where rule_id is not null group by all""",
)
def _(r):
    return in_turn(quality.reject_summary(r.cleaned[t].rejects, by_rule=True) for t in contract.TABLES)


@check(
    "reject_rows_fait_ventes",
    "ticket_nk:s; produit_nk:s; client_nk:s; quantite:i; timestamp_vente:s; rule_id:s",
    """select *, coalesce(strftime(timestamp_vente, '%Y-%m-%d %H:%M:%S'), 'DATE_INVALIDE') as timestamp_vente
    from (select * from judged_sales where rule_id is not null) x""".replace("select *, ", "select * exclude (timestamp_vente), "),
)
def _(r):
    """Rejected sales, read back from their quarantine documents."""
    names = ["ticket_nk", "produit_nk", "client_nk", "quantite", "timestamp_vente"]
    fields = [F.get_json_object("record_data", f"$.{n}").alias(n) for n in names]
    return r.cleaned["fait_ventes"].rejects.select(*fields, "rule_id")


@check(
    "sales_rule_counts",
    "table_name:s; rule_id:s; nb_lignes:i",
    """select 'fait_ventes' table_name, unnest(['quantite_not_positive', 'montant_ttc_negative', 'client_nk_null']) rule_id,
      unnest([count(*) filter (quantite <= 0), count(*) filter (montant_ttc < 0), count(*) filter (client_nk is null)]) nb_lignes
    from landed_sales""",
)
def _(r):
    landed = r.bronze["fait_ventes"].select(*[casts.read_as(c).alias(c.name) for c in contract.SALES.columns])
    rules = [
        quality.Rule("quantite_not_positive", "quantite <= 0", ""),
        quality.Rule("montant_ttc_negative", "montant_ttc < 0", ""),
        *quality.missing("", "client_nk"),
    ]
    return quality.rule_counts(landed, "fait_ventes", rules)


@check(
    "split_by_rule",
    "cote:s; nb_lignes:i",
    """select case when quantite <= 0 then 'rejete' else 'valide' end cote, count(*) nb_lignes from landed_sales group by 1""",
)
def _(r):
    typed = r.bronze["fait_ventes"].withColumn("quantite", casts.to_int(F.col("quantite")))
    valid, rejected = quality.split_invalid(typed, F.col("quantite") <= 0, "fait_ventes", "quantite")
    return volumes({"valide": valid, "rejete": rejected}).withColumnRenamed("table_name", "cote")


def _split_sides(r, optional: bool, strategy: str | None = None) -> DataFrame:
    sales = r.bronze["fait_ventes"]
    ghosts = F.when(F.col("client_nk") != "CLI-GHOST", F.col("client_nk"))
    # Ghost customers of even tickets lose their key, so both kinds of bad key occur.
    even = F.col("ticket_nk").cast("long") % 200 < 100
    keyed = sales.withColumn("client_nk", F.when(even, ghosts).otherwise(F.col("client_nk")))
    valid, rejected = quality.split_orphans(
        keyed, r.bronze["dim_client"], "client_nk", "client_nk", "fait_ventes", "client", optional, strategy
    )
    return volumes({"valide": valid, "rejete": rejected}).withColumnRenamed("table_name", "cote")


check(
    "ri_strict",
    "cote:s; nb_lignes:i",
    """select case when client_nk = 'CLI-GHOST' then 'rejete' else 'valide' end cote, count(*) nb_lignes
    from landed_sales group by 1""",
)(lambda r: _split_sides(r, False))
check(
    "ri_lenient",
    "cote:s; nb_lignes:i",
    """select case when client_nk = 'CLI-GHOST' and cast(ticket_nk as bigint) % 200 >= 100 then 'rejete' else 'valide' end cote,
      count(*) nb_lignes from landed_sales group by 1""",
)(lambda r: _split_sides(r, True))
check(
    "ri_shuffled",
    "cote:s; nb_lignes:i",
    """select case when client_nk = 'CLI-GHOST' then 'rejete' else 'valide' end cote, count(*) nb_lignes
    from landed_sales group by 1""",
)(lambda r: _split_sides(r, False, "merge"))


@check(
    "key_audit",
    "table_name:s; nb_lignes:i; nb_cles:i; nb_surplus:i",
    """select 'lineitem' table_name, count(*) nb_lignes, count(distinct (l_orderkey, l_linenumber)) nb_cles,
      count(*) - count(distinct (l_orderkey, l_linenumber)) nb_surplus from lineitem
    union all select 'fait_ventes', count(*), count(distinct (ticket_nk, produit_nk)),
      count(*) - count(distinct (ticket_nk, produit_nk)) from landed_sales""",
)
def _(r):
    return quality.key_audit(
        {"lineitem": r.table("lineitem"), "fait_ventes": r.bronze["fait_ventes"]},
        {"lineitem": ["l_orderkey", "l_linenumber"], "fait_ventes": list(contract.SALES.key)},
    )


@check(
    "duplicate_keys",
    "l_orderkey:i; l_linenumber:i; nb_lignes:i",
    "select l_orderkey, l_linenumber, count(*) nb_lignes from lineitem group by 1, 2 having count(*) > 1",
)
def _(r):
    return duplicate_keys(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "fk_audit",
    "enfant:s; cle:s; parent:s; nb_cles_orphelines:i; nb_lignes_orphelines:i; nb_lignes_sans_cle:i",
    faults.links_sql(),
)
def _(r):
    """Every declared reference of silver and gold, over rows with faults in six silver and six gold ones."""
    return audit_links(faults.linked_tables(r), faults.SILVER_LINKS + faults.GOLD_LINKS)


check("verdicts", "table_name:s; rule_id:s; nb_lignes:i", faults.rejects_sql())(faults.verdicts)


@check(
    "orphan_and_matched_rows",
    "genre:s; nb_lignes:i",
    """select case when client_nk = 'CLI-GHOST' then 'orphelin' else 'rattache' end genre, count(*) nb_lignes
    from landed_sales group by 1""",
)
def _(r):
    sales, customers = r.bronze["fait_ventes"], r.bronze["dim_client"]
    sides = {
        "orphelin": orphan_rows(sales, "client_nk", customers, "client_nk", salts=8),
        "rattache": matched_rows(sales, "client_nk", customers, "client_nk", salts=8),
    }
    return volumes(sides).withColumnRenamed("table_name", "genre")


@check(
    "contract_notnull",
    "table_name:s; rule_id:s; nb_lignes:i",
    """select 'dim_client' table_name, unnest(['client_nk_null', 'prenom_null', 'nom_null', 'telephone_null', 'ville_null',
      'date_naissance_null', 'date_inscription_null', 'segment_null']) rule_id,
      unnest([count(*) filter (client_nk is null), count(*) filter (prenom is null), count(*) filter (nom is null),
      count(*) filter (telephone is null), count(*) filter (ville is null), count(*) filter (date_naissance is null),
      count(*) filter (date_inscription is null), count(*) filter (segment is null)]) nb_lignes from buyer""",
)
def _(r):
    typed = r.bronze["dim_client"].select(*[casts.read_as(c).alias(c.name) for c in contract.CUSTOMERS.columns])
    return quality.rule_counts(typed, "dim_client", quality.required_rules(contract.CUSTOMERS))


@check(
    "contract_length",
    "table_name:s; rule_id:s; nb_lignes:i",
    """select 'documents' table_name, unnest(['text_too_long', 'lang_too_long']) rule_id,
      unnest([count(*) filter (length(text) > 500), count(*) filter (length(lang) > 2)]) nb_lignes from documents""",
)
def _(r):
    layout = contract.Table("documents", (contract.text("text", 500), contract.text("lang", 2)), key=("text",))
    return quality.rule_counts(r.table("documents"), "documents", quality.length_rules(layout))


@check(
    "error_profile",
    "doublons:i; quantites_invalides:i; montants_negatifs:i; emails_invalides:i",
    """select count(*) - count(distinct (ticket_nk, produit_nk)) doublons, count(*) filter (quantite <= 0) quantites_invalides,
      count(*) filter (montant_ttc < 0) montants_negatifs,
      (select count(*) from customer where c_custkey % 20 = 3) emails_invalides from landed_sales""",
)
def _(r):
    typed = r.bronze["fait_ventes"].select(*[casts.read_as(c).alias(c.name) for c in contract.SALES.columns])
    return quality.error_profile(typed, r.bronze["dim_client"])


# --- source model ----------------------------------------------------------------------------


@check(
    "pricing",
    "produit_nk:i; prix_vente_ht:d; tva_pct:d; prix_vente_ttc:d; marge_brute_ht:d",
    """select *, cast(prix_vente_ht - cost as decimal(12,2)) marge_brute_ht,
      cast(prix_vente_ht * cast(1.2 as decimal(2,1)) as decimal(12,2)) prix_vente_ttc, 20 tva_pct
    from (select p_partkey produit_nk, cast(cast(p_retailprice as decimal(12,2)) * cast(1 + (15 + p_size % 26) / 100.0 as decimal(4,2))
      as decimal(12,2)) prix_vente_ht, cast(p_retailprice as decimal(12,2)) cost from part) x""",
)
def _(r):
    products = r.table("part").select(
        F.col("p_partkey").alias("produit_nk"), F.col("p_retailprice").cast("decimal(12,2)").alias("cost"), "p_size"
    )
    markup = ((F.lit(15) + F.col("p_size") % 26) / F.lit(100)).cast("decimal(4,2)")
    return source_model.price_list(products, "cost", markup, F.lit(20))


@check(
    "line_amounts",
    "ticket_nk:s; produit_nk:s; quantite:i; montant_ht:d; montant_ttc:d; marge_brute_total:d",
    """select ticket_nk, produit_nk, quantite, prix_unitaire_ht * quantite montant_ht, prix_unitaire_ttc * quantite montant_ttc,
      marge_brute_unit * greatest(1, quantite) marge_brute_total from landed_sales""",
)
def _(r):
    typed = r.bronze["fait_ventes"].select(*[casts.read_as(c).alias(c.name) for c in contract.SALES.columns])
    return source_model.sale_line_amounts(typed)


@check(
    "stock_flags",
    "date_snapshot:t; produit_nk:s; magasin_nk:s; valeur_stock_ht:d; seuil_reapprovisionnement:i; en_rupture:b",
    """select * exclude (en_rupture, seuil_reapprovisionnement, valeur_stock_ht), quantite_en_stock * prix_achat_ht valeur_stock_ht,
      greatest(10, quantite_en_stock // 5) seuil_reapprovisionnement, quantite_en_stock = 0 en_rupture
    from silver_stock join item using (produit_nk)""",
)
def _(r):
    costs = r.cleaned["dim_produit"].valid.select("produit_nk", "prix_achat_ht")
    stock = r.cleaned["fait_stock"].valid.join(costs, "produit_nk")
    return source_model.stock_flags(stock, "prix_achat_ht", F.col("quantite_en_stock"))


@check(
    "delivery_dates",
    "o_orderkey:i; livraison:t; retour_max:t",
    """select o_orderkey, cast(o_orderdate as date) + cast(o_orderkey % 10 as integer) livraison,
      least(cast(o_orderdate as date) + 30, date '2001-06-30') retour_max from orders""",
)
def _(r):
    day = F.to_date("o_orderdate")
    return r.table("orders").select(
        "o_orderkey",
        dates.expected_delivery(day, (F.col("o_orderkey") % 10).cast("int")).alias("livraison"),
        dates.capped_date(day, 30, "2001-06-30").alias("retour_max"),
    )


@check(
    "segments",
    "client_nk:s; nom:s; segment:s",
    """select b.client_nk, b.nom, case when ttc >= 500 * n and tickets >= 48 then 'Premium'
      when ttc >= 150 * n and tickets >= 12 then 'Standard' else 'Occasionnel' end segment
    from buyer b left join (select client_nk, count(distinct ticket_nk) tickets, sum(montant_ttc) ttc, count(*) n
      from silver_sales group by 1) s on s.client_nk = b.client_nk""",
)
def _(r):
    return source_model.assign_segments(r.cleaned["dim_client"].valid, r.silver["fait_ventes"])


@check(
    "order_totals",
    "commande_nk:s; montant_total_ht:d",
    "select commande_nk, sum(montant_ligne_ht) montant_total_ht from silver_lines group by 1",
)
def _(r):
    return source_model.order_totals(r.silver["fait_lignes_commandes"])


@check(
    "order_total_audit",
    "commande_nk:s; montant_total_ht:d; total_lignes_ht:d",
    """select o.commande_nk, o.montant_total_ht, coalesce(t, 0) total_lignes_ht from silver_orders o
    left join (select commande_nk, sum(montant_ligne_ht) t from silver_lines group by 1) l on l.commande_nk = o.commande_nk
    where o.montant_total_ht <> coalesce(t, 0)""",
)
def _(r):
    return source_model.order_total_audit(r.silver["fait_commandes"], r.silver["fait_lignes_commandes"])


# --- keys, calendar, sampling -------------------------------------------------------------------


@check(
    "sk_client",
    "c_custkey:i; client_sk:i",
    "select c_custkey, row_number() over (order by substr(md5(cast(c_custkey as varchar)), 1, 3), c_custkey) client_sk from customer",
)
def _(r):
    return dense_keys(r.table("customer"), ["c_custkey"], "client_sk")


@check(
    "sk_stable",
    "c_custkey:i; client_sk:i",
    """select c_custkey, row_number() over (order by c_custkey % 3 <> 0, substr(md5(cast(c_custkey as varchar)), 1, 3), c_custkey)
      client_sk from customer""",
)
def _(r):
    """Keys of every third customer exist; the others are added after them."""
    customers = r.table("customer")
    known = dense_keys(customers.where(F.col("c_custkey") % 3 == 0), ["c_custkey"], "client_sk")
    return extend_keys(known.select("c_custkey", "client_sk"), customers, "c_custkey", "client_sk")


_CAL_SPEC = columns_of(contract.CALENDAR, plus="nb_commandes:i")
_CAL_SQL = """select c.*, coalesce(n, 0) nb_commandes from {0} c
    left join (select cast(o_orderdate as date) dt, count(*) n from orders group by 1) o on o.dt = c.date_complete"""


def _calendar_with_orders(r, days: DataFrame) -> DataFrame:
    daily = r.table("orders").groupBy(F.to_date("o_orderdate").alias("date_complete")).agg(F.count("*").alias("n"))
    return days.join(daily, "date_complete", "left").withColumn("nb_commandes", F.coalesce("n", F.lit(0)))


check("calendar_en", _CAL_SPEC, _CAL_SQL.format("cal"))(
    lambda r: _calendar_with_orders(r, cal.calendar(r.day_bounds()))
)
check("calendar_fr", _CAL_SPEC, _CAL_SQL.format("cal_fr"))(
    lambda r: _calendar_with_orders(r, cal.source_calendar(r.day_bounds()))
)


@check(
    "month_spine",
    "date_snapshot:t; nb_commandes:i",
    """select cast(m as date) date_snapshot, coalesce(n, 0) nb_commandes
    from (select distinct date_trunc('month', date_complete) m from cal) c
    left join (select date_trunc('month', o_orderdate) m2, count(*) n from orders group by 1) o on m2 = m""",
)
def _(r):
    monthly = r.table("orders").groupBy(F.trunc("o_orderdate", "MM").alias("date_snapshot")).agg(F.count("*").alias("n"))
    months = cal.month_starts(r.day_bounds()).join(monthly, "date_snapshot", "left")
    return months.withColumn("nb_commandes", F.coalesce("n", F.lit(0)))


@check(
    "stock_spine",
    "date_snapshot:t; magasin_nk:s; nb_produits:i; nb_sans_stock:i; quantite:i",
    """select cast(m as date) date_snapshot, s.magasin_nk, (select count(*) from item) nb_produits,
      (select count(*) from item) - coalesce(n, 0) nb_sans_stock, coalesce(q, 0) quantite
    from (select distinct date_trunc('month', date_complete) m from cal) c cross join store s
    left join (select date_snapshot, magasin_nk, count(*) n, sum(quantite_en_stock) q from silver_stock group by 1, 2) k
      on k.date_snapshot = c.m and k.magasin_nk = s.magasin_nk""",
)
def _(r):
    """Every product in every store and month, counted by whether there is stock."""
    products, stores = r.cleaned["dim_produit"].valid, r.cleaned["dim_magasin"].valid
    return cal.stock_coverage(r.silver["fait_stock"], products, stores, r.day_bounds())


@check(
    "sample_seeded",
    "ticket_nk:s; produit_nk:s; quantite:i; montant_ttc:d",
    """select * from (select *, row_number() over (order by md5(concat_ws('|', ticket_nk, produit_nk, '42')), ticket_nk, produit_nk) place,
      count(*) over () total from silver_sales) where place <= floor(total * 0.02)""",
)
def _(r):
    return fixed_size_sample(r.silver["fait_ventes"], ["ticket_nk", "produit_nk"], seed=42, fraction=0.02)


# --- views ------------------------------------------------------------------------------------------

_KPI = (
    "total_transactions:i; total_articles_vendus:i; chiffre_affaires_ttc:d; chiffre_affaires_ht:d; marge_brute_totale:d; "
    "taux_marge_pct:d; panier_moyen_ttc:d; clients_actifs:i; total_magasins:i"
)
_MONTH = (
    "annee:i; mois_num:i; mois_nom:s; trimestre:i; magasin_sk:i; magasin_nom:s; magasin_ville:s; total_transactions:i; "
    "articles_vendus:i; chiffre_affaires_ttc:d; chiffre_affaires_ht:d; marge_brute_totale:d; panier_moyen:d"
)
_STORE = (
    "magasin_sk:i; magasin_nk:s; magasin_nom:s; ville:s; region:s; surface_m2:i; total_transactions:i; "
    "total_articles_vendus:i; chiffre_affaires_ttc:d; chiffre_affaires_ht:d; marge_brute_totale:d; taux_marge_pct:d; "
    "panier_moyen_ttc:d; ca_par_m2:d; total_retours:i; montant_retours_rembourse:d; taux_retour_pct:d"
)
_ITEM = (
    "produit_sk:i; produit_nk:s; produit_nom:s; categorie:s; sous_categorie:s; prix_vente_ttc:d; marge_unitaire:d; "
    "fournisseur_nom:s; total_transactions:i; total_quantite_vendue:i; chiffre_affaires_ttc:d; marge_brute_totale:d; "
    "taux_marge_pct:d"
)
_BUYER = (
    "client_sk:i; client_nk:s; nom:s; prenom:s; client_ville:s; segment:s; nb_achats:i; total_articles_achetes:i; "
    "depense_totale_ttc:d; panier_moyen:d; marge_totale_generee:d; date_premier_achat:t; date_dernier_achat:t"
)
_STOCK = (
    "produit_sk:i; produit_nom:s; categorie:s; sous_categorie:s; magasin_nom:s; magasin_ville:s; fournisseur_nom:s; "
    "delai_livraison_jours:i; stock_moyen:d; valeur_stock_moyenne_ht:d; nb_occurrences_rupture:i; taux_rupture_pct:d"
)
_RETURNS = (
    "motif:s; categorie_produit:s; magasin_nom:s; magasin_ville:s; total_retours:i; total_quantite_retournee:i; "
    "total_montant_rembourse:d"
)
_SUMS = (
    "count(*) total_transactions, sum(quantite) total_articles_vendus, sum(montant_ttc) chiffre_affaires_ttc, "
    "sum(montant_ht) chiffre_affaires_ht, sum(marge_brute_total) marge_brute_totale, "
    f"{pct('sum(marge_brute_total)', 'sum(montant_ht)')} taux_marge_pct, "
    f"{half_up('sum(montant_ttc)', 'count(*)')} panier_moyen_ttc, count(distinct client_sk) clients_actifs, "
    "count(distinct magasin_sk) total_magasins"
)

check(
    "kpi_global",
    f"{_KPI}; total_produits_vendus:i",
    f"select {_SUMS}, count(distinct produit_sk) total_produits_vendus from gold_sales",
)(lambda r: views.kpi_overview(r.gold))
check(
    "kpi_filtered",
    _KPI,
    f"""select {_SUMS} from gold_sales join store s using (magasin_sk)
    where date_sk between 19970101 and 19971231 and s.nom = 'Store NATION_3'""",
)(lambda r: dashboard.kpis(r.gold, 1997, "Store NATION_3"))
check("kpi_year", _KPI, f"select {_SUMS} from gold_sales where date_sk between 19970101 and 19971231")(
    lambda r: dashboard.kpis(r.gold, 1997, contract.ALL_STORES)
)
check("sales_monthly", _MONTH, "select * from v_month")(lambda r: views.monthly_sales(r.gold))
check(
    "sales_monthly_filtered",
    _MONTH,
    "select * from v_month where annee = 1998 and magasin_nom = 'Store NATION_7'",
)(lambda r: dashboard.monthly(r.gold, 1998, "Store NATION_7"))
check("store_perf", _STORE, "select * from v_store")(lambda r: views.store_performance(r.gold))
check("product_perf", _ITEM, "select * from v_item")(lambda r: views.product_performance(r.gold))
check("customer_perf", _BUYER, "select * from v_buyer")(lambda r: views.customer_behaviour(r.gold))
check("stock_mgmt", _STOCK, "select * from v_stock")(lambda r: views.stock_management(r.gold))
check("returns_analysis", _RETURNS, "select * from v_returns")(lambda r: views.returns_analysis(r.gold))

# --- dashboard ------------------------------------------------------------------------------------------

check("years", "annee:i", "select distinct annee from gold_sales join cal on date_sk = temps_sk")(
    lambda r: dashboard.available_years(r.gold)
)
check(
    "category_rollup",
    "categorie:s; nb_references:i; quantite_vendue:i; ca_ttc:d; marge_totale:d; marge_pct:d",
    "select * from v_category",
)(lambda r: dashboard.categories(r.gold))
check(
    "segment_rollup",
    "segment:s; nb_clients:i; total_achats:i; ca_total_ttc:d; panier_moyen_segment:d; marge_totale:d",
    "select * from v_segment",
)(lambda r: dashboard.segments(r.gold))
check(
    "city_rollup",
    "ville:s; nb_clients:i; ca_total_ttc:d; panier_moyen_ville:d",
    f"""select client_ville ville, count(*) nb_clients, sum(depense_totale_ttc) ca_total_ttc,
      {half_up('sum(cast(panier_moyen as decimal(18,2)))', 'count(panier_moyen)')} panier_moyen_ville from v_buyer group by 1""",
)(lambda r: dashboard.cities(r.gold))
check(
    "top_products",
    _ITEM,
    "select * from v_item order by chiffre_affaires_ttc desc nulls last, produit_nk limit 50",
)(lambda r: dashboard.top_products(r.gold, 50))
check(
    "top_products_category",
    _ITEM,
    "select * from v_item where categorie = 'ECONOMY' order by chiffre_affaires_ttc desc nulls last, produit_nk limit 10",
)(lambda r: dashboard.top_products(r.gold, 10, "ECONOMY"))
check(
    "top_customers",
    _BUYER,
    "select * from v_buyer order by depense_totale_ttc desc nulls last, client_nk limit 20",
)(lambda r: dashboard.top_customers(r.gold, 20))
check(
    "trend_network",
    "annee:i; mois_num:i; mois_nom:s; chiffre_affaires_ttc:d; marge_brute_totale:d; total_transactions:i; mois_affichage:s",
    """select annee, mois_num, mois_nom, sum(chiffre_affaires_ttc) chiffre_affaires_ttc, sum(marge_brute_totale) marge_brute_totale,
      sum(total_transactions) total_transactions, mois_nom || ' ' || annee mois_affichage from v_month group by 1, 2, 3""",
)(lambda r: dashboard.network_trend(r.gold))
check(
    "quarter_rollup",
    "trimestre:i; chiffre_affaires_ttc:d; marge_brute_totale:d; total_transactions:i; trimestre_label:s",
    """select trimestre, sum(chiffre_affaires_ttc) chiffre_affaires_ttc, sum(marge_brute_totale) marge_brute_totale,
      sum(total_transactions) total_transactions, 'T' || trimestre trimestre_label from v_month group by 1""",
)(lambda r: dashboard.quarters(r.gold))
check(
    "basket_month",
    "mois_num:i; mois_nom:s; chiffre_affaires_ttc:d; total_transactions:i; panier_moyen:d",
    f"""select mois_num, mois_nom, sum(chiffre_affaires_ttc) chiffre_affaires_ttc, sum(total_transactions) total_transactions,
      {dbl('sum(chiffre_affaires_ttc)')} / {dbl('sum(total_transactions)')} panier_moyen from v_month group by 1, 2""",
)(lambda r: dashboard.monthly_basket(r.gold))
_SYNTHESIS = f"""select annee, mois_num, mois_nom, sum(total_transactions) total_transactions, sum(articles_vendus) articles_vendus,
      sum(chiffre_affaires_ht) chiffre_affaires_ht, sum(chiffre_affaires_ttc) chiffre_affaires_ttc,
      sum(marge_brute_totale) marge_brute_totale,
      {dbl('sum(marge_brute_totale)')} / {dbl('sum(chiffre_affaires_ht)')} * 100.0::double taux_marge,
      {dbl('sum(chiffre_affaires_ttc)')} / {dbl('sum(total_transactions)')} panier_moyen
    from v_month group by 1, 2, 3"""
check(
    "month_synthesis",
    "annee:i; mois_num:i; mois_nom:s; total_transactions:i; articles_vendus:i; chiffre_affaires_ht:d; chiffre_affaires_ttc:d; "
    "marge_brute_totale:d; taux_marge:d; panier_moyen:d",
    _SYNTHESIS,
)(lambda r: dashboard.month_synthesis(r.gold))
check(
    "tax_figures",
    "chiffre_affaires_ht:d; montant_tva:d; chiffre_affaires_ttc:d; total_articles_vendus:i; total_transactions:i",
    f"select *, chiffre_affaires_ttc - chiffre_affaires_ht montant_tva from (select {_SUMS} from gold_sales) x",
)(lambda r: dashboard.tax_figures(r.gold))
check(
    "store_benchmark",
    "ca_par_m2_moyen:d; surface_moyenne_m2:d; magasin_leader:s; ca_leader:d; magasin_meilleure_marge:s; "
    "meilleur_taux_marge_pct:d; magasin_moins_de_retours:s; plus_faible_taux_retour_pct:d",
    f"""select {dbl('sum(cast(ca_par_m2 as decimal(18,2)))')} / count(ca_par_m2) ca_par_m2_moyen,
      {dbl('sum(surface_m2)')} / count(*) surface_moyenne_m2,
      (select replace(magasin_nom, 'Store ', '') from v_store order by chiffre_affaires_ttc desc nulls last, magasin_nk limit 1) magasin_leader,
      max(chiffre_affaires_ttc) ca_leader,
      (select replace(magasin_nom, 'Store ', '') from v_store order by taux_marge_pct desc nulls last, magasin_nk limit 1) magasin_meilleure_marge,
      max(taux_marge_pct) meilleur_taux_marge_pct,
      (select replace(magasin_nom, 'Store ', '') from v_store order by taux_retour_pct nulls last, magasin_nk limit 1) magasin_moins_de_retours,
      min(taux_retour_pct) plus_faible_taux_retour_pct
    from v_store""",
)(lambda r: dashboard.store_benchmark(r.gold, "Store "))
check(
    "category_shares",
    "categorie:s; ca_ttc:d; part_ca_pct:d",
    f"""select categorie, ca_ttc, {pct('ca_ttc', 'total')} part_ca_pct
    from v_category, (select sum(ca_ttc) total from v_category) t""",
)(lambda r: dashboard.category_shares(r.gold))
check(
    "category_figures",
    "total_references:i; total_ca_ttc:d; total_quantite:i; categorie_leader:s; ca_leader:d; part_leader_pct:d; "
    "categorie_meilleure_marge:s; meilleure_marge_pct:d",
    f"""select sum(nb_references) total_references, sum(ca_ttc) total_ca_ttc, sum(quantite_vendue) total_quantite,
      (select categorie from v_category order by ca_ttc desc nulls last, categorie limit 1) categorie_leader,
      max(ca_ttc) ca_leader, {pct('max(ca_ttc)', 'sum(ca_ttc)')} part_leader_pct,
      (select categorie from v_category order by marge_pct desc nulls last, categorie limit 1) categorie_meilleure_marge,
      max(marge_pct) meilleure_marge_pct from v_category""",
)(lambda r: dashboard.category_figures(r.gold))
check(
    "customer_figures",
    "total_clients:i; total_ca_ttc:d; panier_moyen_global:d; achats_par_client:i; segment_leader:s; ca_leader:d; part_leader_pct:d",
    f"""select sum(nb_clients) total_clients, sum(ca_total_ttc) total_ca_ttc,
      {dbl('sum(cast(panier_moyen_segment as decimal(18,2)))')} / count(panier_moyen_segment) panier_moyen_global,
      (2 * sum(total_achats) + sum(nb_clients)) // (2 * sum(nb_clients)) achats_par_client,
      (select segment from v_segment order by ca_total_ttc desc nulls last, segment limit 1) segment_leader,
      max(ca_total_ttc) ca_leader, {pct('max(ca_total_ttc)', 'sum(ca_total_ttc)')} part_leader_pct from v_segment""",
)(lambda r: dashboard.customer_figures(r.gold))
check(
    "inventory_figures",
    "valeur_stock_ht:d; nb_fournisseurs:i; delai_moyen:d; total_ruptures:i",
    f"""select sum(cast(valeur_stock_moyenne_ht as decimal(18,2))) valeur_stock_ht,
      (select count(distinct fournisseur_nom) from v_stock) nb_fournisseurs,
      (select {dbl('sum(delai_livraison_jours)')} / count(delai_livraison_jours) from v_stock) delai_moyen,
      sum(nb_occurrences_rupture) total_ruptures from v_stock where magasin_nom = 'Store NATION_5'""",
)(lambda r: dashboard.inventory_figures(r.gold, "Store NATION_5"))
check(
    "stock_by_category",
    "categorie:s; valeur_stock_moyenne_ht:d",
    "select categorie, sum(cast(valeur_stock_moyenne_ht as decimal(18,2))) valeur_stock_moyenne_ht from v_stock group by 1",
)(lambda r: dashboard.stock_by_category(r.gold))
check(
    "lead_time_supplier",
    "fournisseur_nom:s; delai_livraison_jours:d",
    f"""select fournisseur_nom, {dbl('sum(delai_livraison_jours)')} / count(delai_livraison_jours) delai_livraison_jours
    from v_stock where fournisseur_nom is not null group by 1""",
)(lambda r: dashboard.lead_time_by_supplier(r.gold))
check(
    "return_figures",
    "total_retours:i; total_rembourse:d; total_quantite:i; motif_principal:s; taux_retour_pct:d",
    f"""select sum(total_retours) total_retours, sum(total_montant_rembourse) total_rembourse,
      sum(total_quantite_retournee) total_quantite,
      (select motif from v_returns group by 1 order by sum(total_retours) desc, motif limit 1) motif_principal,
      {pct('sum(total_retours)', '(select count(*) from gold_sales)')} taux_retour_pct from v_returns""",
)(lambda r: dashboard.return_figures(r.gold))
check(
    "returns_by_reason",
    "motif:s; total_retours:i",
    "select motif, sum(total_retours) total_retours from v_returns group by 1",
)(lambda r: dashboard.returns_by_reason(r.gold))
check(
    "refund_by_category",
    "categorie_produit:s; total_montant_rembourse:d",
    """select categorie_produit, sum(total_montant_rembourse) total_montant_rembourse from v_returns
    where magasin_nom = 'Store NATION_2' group by 1""",
)(lambda r: dashboard.refunds_by_category(r.gold, "Store NATION_2"))


@check(
    "store_ranking",
    "magasin_nk:s; rang:i",
    "select magasin_nk, row_number() over (order by chiffre_affaires_ttc nulls last, magasin_nk) rang from v_store",
)
def _(r):
    order = Window.orderBy(F.asc_nulls_last("chiffre_affaires_ttc"), "magasin_nk")
    return dashboard.store_ranking_ascending(r.gold).select("magasin_nk", F.row_number().over(order).alias("rang"))


# --- SQL surface and reports ------------------------------------------------------------------------------


@check(
    "sql_kpi_by_year",
    "magasin_nom:s; ca:d; transactions:i",
    """select magasin_nom, sum(chiffre_affaires_ttc) ca, sum(total_transactions) transactions from v_month
    where annee = 1999 group by 1""",
)
def _(r):
    register_views({**r.gold})
    return run_query(
        r.spark,
        """SELECT magasin_nom, ROUND(SUM(chiffre_affaires_ttc)::numeric(20,2), 2) AS ca, SUM(total_transactions) AS transactions
        FROM vue_ventes_mensuelles WHERE annee = :year GROUP BY magasin_nom""",
        year=1999,
    )


@check(
    "sql_tables",
    "categorie:s; n:i",
    "select categorie, count(*) n from gold_sales join item using (produit_sk) where quantite >= 25 group by 1",
)
def _(r):
    register_tables({n: r.gold[n] for n in ("fait_ventes", "dim_produit")})
    return run_query(
        r.spark,
        """SELECT p.categorie, COUNT(*) AS n FROM fait_ventes v JOIN dim_produit p ON v.produit_sk = p.produit_sk
        WHERE v.quantite >= :least GROUP BY p.categorie""",
        least=25,
    )


def _report(name: str, titles: dict[str, str], spec: str, sql: str, run) -> None:
    kinds = dict(c.rsplit(":", 1) for c in spec.split("; "))
    columns = "; ".join(f"{title}:{kinds[c]}" for c, title in titles.items())
    picked = ", ".join(f'{c} as "{title}"' for c, title in titles.items())
    check(name, columns, f"select {picked} from ({sql}) as page")(run)


_report("report_store", reports.STORE_REPORT, _STORE, "select * from v_store", lambda r: reports.store_report(r.gold))
_report(
    "report_month",
    reports.MONTH_REPORT,
    CHECKS["month_synthesis"].columns,
    _SYNTHESIS,
    lambda r: reports.month_report(r.gold),
)
_report(
    "report_product",
    reports.PRODUCT_REPORT,
    _ITEM,
    "select * from v_item order by chiffre_affaires_ttc desc nulls last, produit_nk limit 20",
    lambda r: reports.product_report(r.gold),
)
_report(
    "report_customer",
    reports.CUSTOMER_REPORT,
    _BUYER,
    "select * from v_buyer order by depense_totale_ttc desc nulls last, client_nk limit 20",
    lambda r: reports.customer_report(r.gold),
)
_report(
    "report_stock",
    reports.STOCK_REPORT,
    _STOCK,
    "select * from v_stock order by nb_occurrences_rupture desc, produit_sk, magasin_nom, magasin_ville limit 25",
    lambda r: reports.stock_report(r.gold),
)
_report(
    "report_returns", reports.RETURN_REPORT, _RETURNS, "select * from v_returns", lambda r: reports.return_report(r.gold)
)

# --- alerts and insights ----------------------------------------------------------------------------------------

check(
    "alerts",
    "level:s; code:s; subject:s; amount:d; message:s",
    f"""select 'warning' as level, 'delai_fournisseur' code, string_agg(fournisseur_nom, ', ' order by fournisseur_nom) subject,
      {dbl('max(d)')} amount, 'Délai Approvisionnement Élevé : ' || string_agg(fournisseur_nom, ', ' order by fournisseur_nom)
        || ' (' || max(d) || ' jours)' message
    from (select fournisseur_nom, max(delai_livraison_jours) d from v_stock where delai_livraison_jours > 8 group by 1) w
    union all select 'critical', 'remboursements_categorie', 'PROMO', {dbl('sum(total_montant_rembourse)')},
      'Impact Financier SAV : PROMO totalise ' || format('{{:,}}', {big('round(sum(total_montant_rembourse), 0)')})
        || ' MAD de remboursements (motif dominant : ' || (select motif from v_returns where categorie_produit = 'PROMO'
          group by 1 order by sum(total_retours) desc, motif limit 1) || ')'
    from v_returns where categorie_produit = 'PROMO'
    union all select 'info', 'equilibre_magasins', cast(count(*) as varchar), max(part),
      'Équilibre des Magasins : ' || count(*) || ' magasins, de ' || cast(min(part) as decimal(6,2)) || '% à '
        || cast(max(part) as decimal(6,2)) || '% du volume national'
    from (select {pct('chiffre_affaires_ttc', '(select sum(chiffre_affaires_ttc) from v_store)')} part
      from v_store where chiffre_affaires_ttc is not null) p""",
)(lambda r: insights.alerts(r.gold, "PROMO", 8))
check(
    "insights",
    "level:s; code:s; subject:s; amount:d; message:s",
    f"""select 'insight' as level, 'magasin_leader' code, magasin_nom subject, {dbl('chiffre_affaires_ttc')} amount,
      'Leader Régional : ' || magasin_nom || ' (' || ville || '), ' || format('{{:,}}', {big('round(chiffre_affaires_ttc, 0)')})
        || ' MAD, taux de marge ' || cast(cast(cast(taux_marge_pct as decimal(6,2)) as decimal(6,1)) as varchar) || '%' message
    from (select * from v_store order by chiffre_affaires_ttc desc nulls last, magasin_nk limit 1) s
    union all select 'insight', 'categorie_leader', categorie_leader, {dbl('ca_leader')},
      'Moteur de Revenu & Marge : ' || categorie_leader || ' ' || format('{{:,}}', {big('round(ca_leader, 0)')}) || ' MAD ('
        || cast(cast(cast(part_leader_pct as decimal(6,2)) as decimal(6,1)) as varchar) || '% du CA), meilleure marge '
        || categorie_meilleure_marge || ' ' || cast(cast(cast(meilleure_marge_pct as decimal(6,2)) as decimal(6,1)) as varchar) || '%'
    from ({CHECKS['category_figures'].sql}) c
    union all select 'insight', 'motif_principal', motif, {dbl('n')},
      'Qualité & SAV : « ' || motif || ' » avec ' || format('{{:,}}', {big('n')}) || ' retours'
    from (select motif, sum(total_retours) n from v_returns group by 1 order by n desc, motif limit 1) m""",
)(lambda r: insights.insights(r.gold))

# --- reconciliation ------------------------------------------------------------------------------------------------

# Landed and silver rows of the tables; gold's calendar has a range of its own.
_PAIRS = {
    "dim_temps": ("cal_fr", "cal_fr"),
    "dim_magasin": ("store", "store"),
    "dim_fournisseur": ("vendor", "vendor"),
    "dim_produit": ("item", "item"),
    "dim_client": ("buyer", "buyer"),
    "fait_stock": ("silver_stock", "silver_stock"),
    "fait_commandes": ("silver_orders", "silver_orders"),
    "fait_lignes_commandes": ("landed_lines", "silver_lines"),
    "fait_ventes": ("landed_sales", "silver_sales"),
    "fait_retours": ("(select 1 from line where rf = 'R')", "silver_returns"),
}


def _pair_sql(left: bool, a: str, b: str, skip: str = "") -> str:
    rows = " union all ".join(
        f"select '{t}' table_name, (select count(*) from {p[0] if left else p[1]} q) {a}, (select count(*) from {p[1]} q) {b}"
        for t, p in _PAIRS.items() if t != skip
    )
    return f"select coalesce(table_name, 'TOTAL') table_name, sum({a}) {a}, sum({b}) {b} from ({rows}) group by rollup (table_name)"


check(
    "recon_silver",
    "table_name:s; nb_bronze:i; nb_silver:i; nb_ecartes:i",
    f"select *, nb_bronze - nb_silver nb_ecartes from ({_pair_sql(True, 'nb_bronze', 'nb_silver')}) x",
)(lambda r: reconcile.layer_diff(written.built(r).counts("bronze"), written.built(r).counts("silver")))
check(
    "recon_gold",
    "table_name:s; nb_silver:i; nb_gold:i; statut:s",
    f"""select *, case when nb_silver = nb_gold then 'MATCH' else 'MISMATCH' end statut
    from ({_pair_sql(False, 'nb_silver', 'nb_gold', 'dim_temps')}) x""",
)(lambda r: reconcile.layer_match(written.built(r).counts("silver"), written.built(r).counts("gold")))
check(
    "volumes",
    "table_name:s; nb_lignes:i",
    " union all ".join(f"select '{t}' table_name, count(*) nb_lignes from {p[0]} q" for t, p in _PAIRS.items()),
)(lambda r: written.built(r).counts("bronze"))


@check(
    "calendar_fit",
    "cote:s; nb_lignes:i; premier:t; dernier:t",
    """select case when cast(ticket_nk as bigint) % 100 = 41 then 'quarantaine' else 'garde' end cote, count(*) nb_lignes,
      min(case when cast(ticket_nk as bigint) % 100 = 41 then cast('1895-06-01' as date) else date_vente end) premier,
      max(case when cast(ticket_nk as bigint) % 100 = 41 then cast('1895-06-01' as date) else date_vente end) dernier
    from silver_sales group by 1""",
)
def _(r):
    """Gold without a given calendar, where a part of the sales lies in 1895: each is kept or in quarantine."""
    lake = written.silver_copy(r, fait_ventes=lambda sales: sales.withColumn(
        "date_vente", F.when(F.expr("cast(ticket_nk as bigint) % 100 = 41"), F.lit("1895-06-01").cast("date")).otherwise(F.col("date_vente"))
    ))
    warehouse.run_gold(lake, audit=False)
    days = lake.read("gold", "dim_temps").select(F.col("temps_sk").alias("date_sk"), "date_complete")
    kept = lake.read("gold", "fait_ventes").join(days, "date_sk").select(F.lit("garde").alias("cote"), "date_complete")
    outside = lake.rejects("gold").where(F.col("reason") == contract.OUTSIDE_CALENDAR).where("table_name = 'fait_ventes'")
    day = F.to_date(F.get_json_object("record_data", "$.date_sk"), "yyyyMMdd").alias("date_complete")
    both = kept.unionByName(outside.select(F.lit("quarantaine").alias("cote"), day))
    return both.groupBy("cote").agg(
        F.count("*").alias("nb_lignes"), F.min("date_complete").alias("premier"), F.max("date_complete").alias("dernier")
    )


@check(
    "gold_rerun",
    "annee_mois:i; nb_lignes:i; montant_ttc:d; versions:i",
    f"""select cast(year(date_vente) * 100 + month(date_vente) as bigint) annee_mois, count(*) nb_lignes, {dbl('sum(montant_ttc)')} montant_ttc,
      2 versions from silver_sales where not (year(date_vente) = 1997 and month(date_vente) = 3) group by 1""",
)
def _(r):
    """Gold refreshed after a month has gone from silver: the month is gone from gold, and the version before is still there."""
    lake = written.silver_copy(r)
    warehouse.run_gold(lake, audit=False)
    sales = lake.read("silver", "fait_ventes")
    with lake.refresh("silver", keep=1) as out:
        for name in contract.TABLES:
            rows = sales.where("date_format(date_vente, 'yyyyMM') <> '199703'") if name == "fait_ventes" else lake.read("silver", name)
            out.write(rows, "silver", name)
    warehouse.run_gold(lake, audit=False, keep_keys=True)
    months = lake.read("gold", "fait_ventes").groupBy("annee_mois").agg(
        F.count("*").alias("nb_lignes"), F.sum("montant_ttc").alias("montant_ttc")
    )
    return months.withColumn("versions", F.lit(len(lake.versions("gold"))))


@check(
    "stream_to_silver",
    "ticket_nk:s; produit_nk:s; magasin_nk:s; client_nk:s; date_vente:t; timestamp_vente:t; quantite:i; prix_unitaire_ttc:d; montant_ttc:d",
    "select * from silver_sales",
)
def _(r):
    """Even tickets land as files, odd ones as an event stream; silver is run over both."""
    sales, odd = r.silver["fait_ventes"], F.expr("cast(ticket_nk as bigint) % 2 = 1")
    lake = written.landed(r, fait_ventes=r.bronze["fait_ventes"].where(~odd))
    write_event_lines(nest_sales(sales.where(odd)), f"{lake.root}/events/ventes")
    write_event_lines(return_events(r.silver["fait_retours"].where("false")), f"{lake.root}/events/retours")
    streams = [event_stream(r.spark, "text", f"{lake.root}/events/{t}") for t in ("ventes", "retours")]
    queries = start_event_ingest(*streams, f"{lake.root}/bronze", f"{lake.root}/checkpoints", interval=None)
    wait(r.spark, queries, 600)
    warehouse.run_silver(lake, audit=False)
    return lake.read("silver", "fait_ventes")

# --- events -----------------------------------------------------------------------------------------------------------


@check(
    "events_parse",
    "event_id:i; event_type:s; k:i",
    """select event_id, event_type, cast(json_extract_string(props, '$.k') as bigint) k from events""",
)
def _(r):
    from pyspark.sql import types as T

    raw = r.table("events").select("event_id", "event_type", F.col("props").alias("value"))
    props = F.from_json("value", T.StructType([T.StructField("k", T.IntegerType())]))
    return raw.select("event_id", "event_type", props["k"].alias("k"))


@check(
    "events_routed",
    "event_type:s; nb_evenements:i; total:d",
    """select event_type, count(*) nb_evenements, cast(sum(cast(value as decimal(18,2))) as double) total from events
    where event_type in ('purchase', 'error') group by 1""",
)
def _(r):
    rows = r.table("events").select(
        F.to_json(F.struct("event_type", F.col("value").cast("decimal(18,2)").alias("amount"))).alias("value")
    )
    parts = [route_by_type(rows, kind) for kind in ("purchase", "error")]
    fields = F.from_json("value", "event_type string, amount decimal(18,2)").alias("e")
    routed = reduce(DataFrame.unionByName, parts).select(fields).select("e.*")
    return routed.groupBy("event_type").agg(F.count("*").alias("nb_evenements"), F.sum("amount").alias("total"))


@check(
    "events_total",
    "sort:s; nb_evenements:i; nb_lignes:i",
    """select case cast(ticket_nk as bigint) % 10 when 1 then 'type inconnu' when 2 then 'type inconnu' when 3 then 'evenement sans ligne'
        when 4 then 'json illisible' else 'VENTE' end sort, count(distinct ticket_nk) nb_evenements,
      sum(case when cast(ticket_nk as bigint) % 10 between 1 and 4 then 0 else 1 end) nb_lignes
    from silver_sales group by 1
    union all select 'RETOUR', count(*), count(*) from silver_returns""",
)
def _(r):
    """A mixed topic with events without a type, of a foreign type, without lines, and cut off: each is a row's source or a dead letter."""
    value, ticket = F.col("value"), F.get_json_object("value", "$.ticket_nk").cast("long") % 10
    sales = nest_sales(r.silver["fait_ventes"]).select(
        F.when(ticket == 1, F.regexp_replace(value, '"event_type":"VENTE",', ""))
        .when(ticket == 2, F.regexp_replace(value, '"event_type":"VENTE"', '"event_type":"PROMO"'))
        .when(ticket == 3, F.regexp_replace(value, r'"lignes":\[.*\]', '"lignes":[]'))
        .when(ticket == 4, F.substring(value, 1, 40))
        .otherwise(value).alias("value")
    )
    lines = F.when(F.col("kind") == contract.EVENT_SALE, F.size("lignes")).when(F.col("kind") == contract.EVENT_RETURN, 1).otherwise(0)
    counted = in_turn(
        judged(events).groupBy(F.coalesce("kind", "reason").alias("sort")).agg(F.count("*").alias("n"), F.sum(lines).alias("lignes"))
        for events in (sales, return_events(r.silver["fait_retours"]))
    )
    return counted.groupBy("sort").agg(F.sum("n").alias("nb_evenements"), F.sum("lignes").alias("nb_lignes"))


@check(
    "events_nested",
    "ticket_nk:s; nb_evenements:i; nb_lignes:i; total:d",
    """select ticket_nk, 1 nb_evenements, count(*) nb_lignes, sum(montant_ttc) total
    from silver_sales group by 1""",
)
def _(r):
    from bazaarlake.streaming.events import SALE_EVENT

    events = parse(nest_sales(r.silver["fait_ventes"]), SALE_EVENT)
    return events.groupBy("ticket_nk").agg(
        F.count("*").alias("nb_evenements"),
        F.sum(F.size("lignes")).alias("nb_lignes"),
        F.max(F.col("montant_total_ttc").cast("decimal(18,2)")).alias("total"),
    )


@check(
    "events_roundtrip",
    "ticket_nk:s; timestamp_vente:t; magasin_nk:s; client_nk:s; produit_nk:s; quantite:i; prix_unitaire_ttc:d; montant_ttc:d; "
    "prix_unitaire_ht:d",
    """select * exclude (prix_unitaire_ht), cast(null as double) prix_unitaire_ht from silver_sales""",
)
def _(r):
    rows = sale_rows(nest_sales(r.silver["fait_ventes"]))
    return rows.withColumn("timestamp_vente", casts.to_moment(F.col("timestamp_vente")))


@check(
    "stream_returns_rows",
    "retour_nk:s; ticket_nk:s; produit_nk:s; quantite_retournee:i; montant_rembourse:d; motif:s",
    "select * exclude (ticket_nk), cast(null as varchar) ticket_nk from silver_returns",
)
def _(r):
    return return_rows(return_events(r.silver["fait_retours"]))


@check(
    "sale_expressions",
    "ticket_nk:s; produit_nk:s; ht_derive:d; marge_derivee:d; part_tva:d; etiquette:s",
    f"""select ticket_nk, produit_nk, {half_up('montant_ttc * 10', '12')} ht_derive,
      cast(prix_unitaire_ht * cast(0.2 as decimal(2,1)) as decimal(12,2)) marge_derivee,
      cast(case when montant_ttc = 0 then null else
        cast(cast(1000 as hugeint) * 2 * cast((montant_ttc - montant_ht) * 100 as hugeint) + cast(montant_ttc * 100 as hugeint) as hugeint)
        // (2 * cast(montant_ttc * 100 as hugeint)) end as double) / 10.0 part_tva,
      case month(date_vente) {" ".join(f"when {i + 1} then '{n}'" for i, n in enumerate(contract.MONTH_NAMES["fr"]))} end
        || ' ' || year(date_vente) etiquette
    from silver_sales""",
)
def _(r):
    sales = r.silver["fait_ventes"]
    day = F.col("date_vente")
    return sales.select(
        "ticket_nk",
        "produit_nk",
        amounts.net_or_derived(casts.null_of("decimal(12,2)"), F.col("montant_ttc")).alias("ht_derive"),
        amounts.unit_margin_or_derived(casts.null_of("decimal(12,2)"), F.col("prix_unitaire_ht")).alias("marge_derivee"),
        amounts.vat_share(F.col("montant_ttc"), F.col("montant_ht")).alias("part_tva"),
        text.month_label(dates.month_name(day, "fr"), F.year(day)).alias("etiquette"),
    )
