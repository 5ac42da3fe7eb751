"""The SQL counterparts: the same tables written as common table expressions for DuckDB.

They start from the typed given tables, not from text, and state the rules as plain
predicates, so they share no step with the Spark code. Amounts are decimals; quotients
are rounded half up in whole numbers.
"""

from __future__ import annotations

import re

from bazaarlake import contract


def half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded half up to two digits (both at most two digits)."""
    n = f"cast(({numerator}) * 100 as hugeint)"
    d = f"cast(({denominator}) * 100 as hugeint)"
    return (
        f"(case when ({denominator}) is null or ({denominator}) = 0 then null "
        f"else cast((2 * {n} * 100 + {d}) // (2 * {d}) as double) / 100.0 end)"
    )


def pct(numerator: str, denominator: str) -> str:
    return half_up(f"({numerator}) * 100", denominator)


def dbl(expression: str) -> str:
    return f"cast({expression} as double)"


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


def _sk(natural: str) -> str:
    return f"cast(row_number() over (order by substr(md5({natural}), 1, 3), {natural}) as bigint)"


def _month_case(column: str, locale: str) -> str:
    return "case " + " ".join(
        f"when month({column}) = {i + 1} then '{n}'" for i, n in enumerate(contract.MONTH_NAMES[locale])
    ) + " end"


def _day_case(column: str, locale: str) -> str:
    return "case " + " ".join(
        f"when isodow({column}) = {i + 1} then '{n}'" for i, n in enumerate(contract.DAY_NAMES[locale])
    ) + " end"


HOLIDAYS = ", ".join(f"date '{d}'" for d in contract.HOLIDAYS_2024)


def _calendar(locale: str, number: str, holidays: str | None) -> str:
    off = f"d in ({holidays})" if holidays else "false"
    return f"""
    select cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) temps_sk, d date_complete, day(d) jour,
      {number} jour_semaine_num, {_day_case('d', locale)} jour_semaine_nom, weekofyear(d) semaine_annee,
      month(d) mois_num, {_month_case('d', locale)} mois_nom, quarter(d) trimestre,
      case when month(d) <= 6 then 1 else 2 end semestre, year(d) annee,
      isodow(d) >= 6 est_weekend, {off} est_ferie, isodow(d) < 6 and not ({off}) est_jour_ouvre
    from days"""


_CLASH = "timestamp_vente, date_vente, magasin_nk, client_nk, quantite, prix_unitaire_ht, tva_pct, " \
    "prix_unitaire_ttc, montant_ht, montant_ttc, marge_brute_unit, marge_brute_total"

# Name to body, in dependency order.
CTES: dict[str, str] = {
    "days": """
    select cast(d as date) d from (
      select unnest(generate_series(
        cast(date_trunc('year', min(o_orderdate)) as timestamp),
        cast(date_trunc('year', max(o_orderdate)) as timestamp) + interval 1 year - interval 1 day,
        interval 1 day)) d
      from orders)""",
    "line": """
    select l_orderkey k, l_partkey p, l_linenumber ln, l_returnflag rf, s_nationkey nat, o_custkey cust,
      o_orderpriority prio, cast(o_orderdate as date) dt, cast(l_quantity as bigint) q,
      cast(cast(l_extendedprice as decimal(18,4)) * (1 - cast(l_discount as decimal(18,4))) as decimal(18,4)) net,
      cast(l_tax as decimal(18,4)) tax
    from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey""",
    "priced": """
    select *, cast(net * (1 + tax) as decimal(18,6)) gross, cast(net * cast(0.2 as decimal(2,1)) as decimal(18,5)) margin
    from line""",
    "landed_sales": """
    select cast(k as varchar) ticket_nk, case when k % 100 = 37 then null else cast(dt as timestamp) end timestamp_vente,
      dt date_vente, cast(nat as varchar) magasin_nk,
      case when k % 100 = 23 then 'CLI-GHOST' else cast(cust as varchar) end client_nk, cast(p as varchar) produit_nk,
      cast(case when k % 50 = 7 then -(ln % 3) else q end as bigint) quantite,
      cast(sgn * ((cast(net * 10000 as bigint) + 50 * q) // (100 * q)) / 100.0 as decimal(12,2)) prix_unitaire_ht,
      cast(tax * 100 as decimal(5,2)) tva_pct,
      cast(sgn * ((cast(gross * 1000000 as bigint) + 5000 * q) // (10000 * q)) / 100.0 as decimal(12,2)) prix_unitaire_ttc,
      cast(sgn * net as decimal(12,2)) montant_ht, cast(sgn * gross as decimal(12,2)) montant_ttc,
      cast(sgn * ((cast(margin * 100000 as bigint) + 500 * q) // (1000 * q)) / 100.0 as decimal(12,2)) marge_brute_unit,
      cast(sgn * margin as decimal(12,2)) marge_brute_total
    from (select *, case when k % 100 = 11 then -1 else 1 end sgn from priced) x
    join (values (1), (2)) c(n) on n = 1 or (k + ln) % 33 = 0""",
    "judged_sales": """
    select *, case
      when timestamp_vente is null then 'timestamp_vente_null'
      when quantite <= 0 then 'quantite_not_positive'
      when montant_ttc < 0 then 'montant_ttc_negative'
      when client_nk not in (select cast(c_custkey as varchar) from customer) then 'client_nk_orphan'
      end rule_id
    from landed_sales""",
    "silver_sales": f"""
    select * exclude (rn, rule_id) from (
      select *, row_number() over (partition by ticket_nk, produit_nk order by {_CLASH}) rn
      from judged_sales where rule_id is null)
    where rn = 1""",
    "landed_returns": """
    select concat_ws('-', k, p, ln) retour_nk, cast(k as varchar) ticket_nk, cast(p as varchar) produit_nk,
      cast(nat as varchar) magasin_nk, cast(cust as varchar) client_nk, dt date_vente_originale,
      dt + cast(ln + 1 as integer) date_retour, q quantite_retournee, cast(gross as decimal(12,2)) montant_rembourse,
      prio motif
    from priced where rf = 'R'""",
    "silver_returns": """
    select * exclude (rn) from (
      select *, row_number() over (partition by retour_nk order by ticket_nk, produit_nk, magasin_nk, client_nk,
        date_vente_originale, date_retour, quantite_retournee, montant_rembourse, motif) rn
      from landed_returns)
    where rn = 1""",
    "landed_lines": """
    select cast(l_orderkey as varchar) commande_nk, cast(l_partkey as varchar) produit_nk,
      cast(l_quantity as bigint) quantite_commandee,
      cast(((cast(cast(l_extendedprice as decimal(18,4)) * 10000 as bigint) + 50 * cast(l_quantity as bigint))
        // (100 * cast(l_quantity as bigint))) / 100.0 as decimal(12,2)) prix_unitaire_achat,
      cast(cast(l_extendedprice as decimal(18,4)) as decimal(12,2)) montant_ligne_ht
    from lineitem""",
    "silver_lines": """
    select * exclude (rn) from (
      select *, row_number() over (partition by commande_nk, produit_nk
        order by quantite_commandee, prix_unitaire_achat, montant_ligne_ht) rn
      from landed_lines)
    where rn = 1""",
    "silver_orders": """
    select cast(o_orderkey as varchar) commande_nk, cast(o_orderkey % 10 as varchar) fournisseur_nk,
      cast(o_orderkey % 25 as varchar) magasin_nk, cast(o_orderdate as date) date_commande,
      cast(o_orderdate as date) + cast(o_orderkey % 10 as integer) date_livraison_prev, o_orderstatus statut,
      cast(coalesce(total, 0) as decimal(12,2)) montant_total_ht
    from orders left join (
      select l_orderkey, sum(cast(l_extendedprice as decimal(18,4))) total from lineitem group by l_orderkey) t
    on l_orderkey = o_orderkey""",
    "silver_stock": """
    select cast(date_trunc('month', dt) as date) date_snapshot, cast(p as varchar) produit_nk,
      cast(nat as varchar) magasin_nk, cast(sum(q) as bigint) quantite_en_stock,
      cast(cast(sum(q) * any_value(cast(p_retailprice as decimal(18,4))) * cast(0.8 as decimal(2,1)) as decimal(18,4))
        as decimal(12,2)) valeur_stock_ht,
      10 seuil_reapprovisionnement, sum(q) % 7 = 0 en_rupture
    from line join part on p = p_partkey group by 1, 2, 3""",
    "store": f"""
    select {_sk('magasin_nk')} magasin_sk, * from (
      select cast(n_nationkey as varchar) magasin_nk, 'Store ' || n_name nom, n_name ville, r_name region,
        'T' || (n_nationkey % 3) type, 500 + 100 * n_nationkey surface_m2
      from nation join region on n_regionkey = r_regionkey
      union all select '99', 'Store EMPTY', 'NOWHERE', 'NONE', 'T0', 1000)""",
    "vendor": f"""
    select {_sk('fournisseur_nk')} fournisseur_sk, * from (
      select cast(s_suppkey as varchar) fournisseur_nk, s_name nom, 'C' || (s_suppkey % 5) categorie_principale,
        n_name pays, cast(s_suppkey % 15 as integer) delai_livraison_jours
      from supplier join nation on s_nationkey = n_nationkey)""",
    "item": f"""
    select {_sk('produit_nk')} produit_sk, i.*, fournisseur_sk from (
      select cast(p_partkey as varchar) produit_nk, p_name nom, p_type categorie, p_brand sous_categorie,
        cast(p_partkey % 10 as varchar) fournisseur_nk,
        cast(price * cast(0.8 as decimal(2,1)) as decimal(12,2)) prix_achat_ht, cast(price as decimal(12,2)) prix_vente_ht,
        cast(vat as decimal(5,2)) tva_pct,
        cast(price * cast(1 + vat / 100.0 as decimal(5,2)) as decimal(12,2)) prix_vente_ttc,
        cast(price * cast(0.2 as decimal(2,1)) as decimal(12,2)) marge_brute_ht
      from (select *, cast(p_retailprice as decimal(18,4)) price, case when p_partkey % 2 = 0 then 20 else 14 end vat from part)
      union all select 'UNSOLD', 'unsold thing', 'NONE', 'Brand#0', '0', 8, 10, 20, 12, 2) i
    left join vendor using (fournisseur_nk)""",
    "buyer": f"""
    select {_sk('client_nk')} client_sk, * from (
      select cast(c_custkey as varchar) client_nk, 'P' || c_custkey prenom, c_name nom,
        case when c_custkey % 20 = 3 then null else 'c' || c_custkey || '@mail.com' end email,
        '06' || c_custkey telephone, n_name ville,
        date '1960-01-01' + cast(c_custkey % 10000 as integer) date_naissance,
        date '1994-01-01' + cast(c_custkey % 300 as integer) date_inscription, c_mktsegment segment
      from customer join nation on c_nationkey = n_nationkey
      union all select 'IDLE', 'Nobody', 'Idle', 'idle@mail.com', '060', 'NOWHERE', date '1970-01-01', date '1994-01-01', 'NONE')""",
    "cal": _calendar("en", "cast(dayofweek(d) + 1 as integer)", None),
    "cal_fr": _calendar("fr", "cast(isodow(d) - 1 as integer)", HOLIDAYS),
    "gold_sales": """
    select v.*, magasin_sk, produit_sk, client_sk,
      cast(year(date_vente) * 10000 + month(date_vente) * 100 + day(date_vente) as integer) date_sk
    from silver_sales v join store s using (magasin_nk) join item i using (produit_nk) left join buyer b using (client_nk)""",
    "gold_returns": """
    select r.*, magasin_sk, produit_sk, client_sk
    from silver_returns r join store using (magasin_nk) join item using (produit_nk) left join buyer using (client_nk)""",
    "gold_stock": """
    select s.*, magasin_sk, produit_sk from silver_stock s join store using (magasin_nk) join item using (produit_nk)""",
    "gold_orders": f"""
    select {_sk('commande_nk')} commande_sk, commande_nk, fournisseur_sk, magasin_sk, date_commande, date_livraison_prev,
      statut, montant_total_ht
    from silver_orders join store using (magasin_nk) join vendor using (fournisseur_nk)""",
    # --- views; sums stay decimal, counts integer ---
    "v_month": f"""
    select annee, mois_num, mois_nom, trimestre, magasin_sk, s.nom magasin_nom, s.ville magasin_ville, count(*) total_transactions,
      sum(quantite) articles_vendus, sum(montant_ttc) chiffre_affaires_ttc, sum(montant_ht) chiffre_affaires_ht,
      sum(marge_brute_total) marge_brute_totale, {half_up('sum(montant_ttc)', 'count(*)')} panier_moyen
    from gold_sales v join cal on date_sk = temps_sk join store s using (magasin_sk)
    group by 1, 2, 3, 4, 5, 6, 7""",
    "v_store": f"""
    select s.magasin_sk, s.magasin_nk, s.nom magasin_nom, s.ville, s.region, s.surface_m2, coalesce(n, 0) total_transactions,
      articles total_articles_vendus, ttc chiffre_affaires_ttc, ht chiffre_affaires_ht, marge marge_brute_totale,
      {pct('marge', 'ht')} taux_marge_pct, {half_up('ttc', 'n')} panier_moyen_ttc, {half_up('ttc', 's.surface_m2')} ca_par_m2,
      coalesce(r, 0) total_retours, coalesce(remb, 0) montant_retours_rembourse, {pct('coalesce(r, 0)', 'n')} taux_retour_pct
    from store s
    left join (select magasin_sk, count(*) n, sum(quantite) articles, sum(montant_ttc) ttc, sum(montant_ht) ht,
      sum(marge_brute_total) marge from gold_sales group by 1) v on v.magasin_sk = s.magasin_sk
    left join (select magasin_sk, count(*) r, sum(montant_rembourse) remb from gold_returns group by 1) b
      on b.magasin_sk = s.magasin_sk""",
    "v_item": f"""
    select i.produit_sk, i.produit_nk, i.nom produit_nom, categorie, sous_categorie, prix_vente_ttc,
      marge_brute_ht marge_unitaire, f.nom fournisseur_nom, coalesce(n, 0) total_transactions, articles total_quantite_vendue,
      ttc chiffre_affaires_ttc, marge marge_brute_totale, {pct('marge', 'ht')} taux_marge_pct
    from item i left join vendor f on f.fournisseur_sk = i.fournisseur_sk
    left join (select produit_sk, count(*) n, sum(quantite) articles, sum(montant_ttc) ttc, sum(montant_ht) ht,
      sum(marge_brute_total) marge from gold_sales group by 1) v on v.produit_sk = i.produit_sk""",
    "v_buyer": f"""
    select b.client_sk, b.client_nk, b.nom, b.prenom, b.ville client_ville, b.segment, coalesce(n, 0) nb_achats,
      coalesce(articles, 0) total_articles_achetes, coalesce(ttc, 0) depense_totale_ttc, {half_up('ttc', 'n')} panier_moyen,
      coalesce(marge, 0) marge_totale_generee, d1 date_premier_achat, d2 date_dernier_achat
    from buyer b left join (select client_sk, count(*) n, sum(quantite) articles, sum(montant_ttc) ttc,
      sum(marge_brute_total) marge, min(date_vente) d1, max(date_vente) d2 from gold_sales group by 1) v
      on v.client_sk = b.client_sk""",
    "v_stock": f"""
    select s.produit_sk, i.nom produit_nom, i.categorie, i.sous_categorie, m.nom magasin_nom, m.ville magasin_ville,
      f.nom fournisseur_nom, f.delai_livraison_jours, {dbl('sum(quantite_en_stock)')} / {dbl('count(*)')} stock_moyen,
      {half_up('sum(valeur_stock_ht)', 'count(*)')} valeur_stock_moyenne_ht,
      count(*) filter (en_rupture) nb_occurrences_rupture, {pct('count(*) filter (en_rupture)', 'count(*)')} taux_rupture_pct
    from gold_stock s join item i using (produit_sk) join store m using (magasin_sk)
    left join vendor f on f.fournisseur_sk = i.fournisseur_sk
    group by 1, 2, 3, 4, 5, 6, 7, 8""",
    "v_returns": """
    select motif, categorie categorie_produit, m.nom magasin_nom, m.ville magasin_ville, count(*) total_retours,
      sum(quantite_retournee) total_quantite_retournee, sum(montant_rembourse) total_montant_rembourse
    from gold_returns r join item i using (produit_sk) join store m using (magasin_sk)
    group by 1, 2, 3, 4""",
    "v_category": f"""
    select categorie, count(distinct produit_sk) nb_references, sum(total_quantite_vendue) quantite_vendue,
      sum(chiffre_affaires_ttc) ca_ttc, sum(marge_brute_totale) marge_totale,
      case when sum(chiffre_affaires_ttc) is null or sum(chiffre_affaires_ttc) = 0 then null else
        cast((2 * cast(sum(marge_brute_totale) * 100 as hugeint) * 120 * 100 + cast(sum(chiffre_affaires_ttc) * 100 as hugeint))
        // (2 * cast(sum(chiffre_affaires_ttc) * 100 as hugeint)) as double) / 100.0 end marge_pct
    from v_item group by 1""",
    "v_segment": f"""
    select segment, count(*) nb_clients, sum(nb_achats) total_achats, sum(depense_totale_ttc) ca_total_ttc,
      {half_up('sum(cast(panier_moyen as decimal(18,2)))', 'count(panier_moyen)')} panier_moyen_segment,
      sum(marge_totale_generee) marge_totale
    from v_buyer group by 1""",
}


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [n for n in CTES if n in words]


def query(select: str) -> str:
    """The select with the table expressions it needs, directly or not, in front."""
    needed: set[str] = set()
    pending = _uses(select)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += [n for n in _uses(CTES[name]) if n != name]
    parts = [f"{n} as ({CTES[n]})" for n in CTES if n in needed]
    return f"with {', '.join(parts)} {select}" if parts else select
