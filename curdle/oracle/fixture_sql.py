"""Fixture SQL (DuckDB dialect) — the dirty projections of FIXTURES.md §2, with more faults: dates that cannot be read,
collections over ten weeks, every line item as a loss, a value with the hash's separator byte, and names of their own.

Used only by the oracle; the Spark side builds the same files with the DataFrame API
(curdle.sources.fixtures)."""

FIXTURE_SQL: dict[str, str] = {
    "raw_cooperados": """
select cast(s_suppkey as string) as id_cooperado,
       concat(' ', s_name, ' ') as nome,
       case when s_suppkey % 20 = 3 then '' else concat(case when s_suppkey % 30 = 4 then 'DOC' || chr(31) else 'DOC-' end, cast(s_suppkey as string)) end as cpf_cnpj,
       case when s_suppkey % 25 = 0 then '05/03/2015' when s_suppkey % 25 = 7 then 'sem data'
            else cast(cast('2010-01-01' as date) + cast(s_suppkey * 37 % 4700 as int) as string) end as data_adesao,
       if(s_suppkey % 50 = 9, 'demitido', case s_suppkey % 5 when 0 then 'Ativo' when 1 then 'ATIVO' when 2 then 'inativo' when 3 then ' Suspenso' else 'Ativo' end) as situacao,
       1 as _batch
from supplier
""",
    "raw_fazendas": """
select cast(c_custkey as string) as id_fazenda,
       cast(c_custkey % 10 as string) as id_cooperado,
       concat(c_name, ' ') as nome_fazenda,
       concat('Town ', cast(c_nationkey as string)) as municipio,
       case when c_custkey % 12 = 0 then '' else cast(cast(50 + c_custkey % 1950 as decimal(18,1)) as string) end as area_hectares,
       case when c_custkey % 20 = 0 then '' else cast(20 + c_custkey % 280 as string) end as qtd_animais_lactacao,
       case when c_custkey % 4 = 0 then lower(c_mktsegment) else c_mktsegment end as raca_predominante,
       1 as _batch
from customer
""",
    "raw_rotas": """
select cast(n_nationkey as string) as id_rota,
       concat('Rota ', n_name) as nome_rota,
       concat('Town ', cast(n_regionkey as string)) as municipio_origem,
       cast(cast(30 + n_nationkey * 15 as decimal(18,1)) as string) as km_total,
       case n_nationkey % 3 when 0 then 'Tipo 1' when 1 then 'Tipo 2 ' else 'Tipo 3' end as veiculo_tipo,
       case n_nationkey % 4 when 0 then 'Não' when 1 then 'SIM' else 'sim' end as ativa,
       1 as _batch
from nation
""",
    "raw_coletas_a": """
select cast(event_id as string) as id_coleta, cast(user_id as string) as id_fazenda, cast(user_id % 25 as string) as id_rota,
       case when event_id % 40 = 7 then 'n/d' else concat(substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 9, 2), '/', substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 6, 2), '/', substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 1, 4)) end as data_coleta,
       cast(cast(case when event_id % 100 = 0 then -value else value end as decimal(18,2)) as string) as volume_litros,
       case when event_id % 17 = 0 then '' else cast(cast(2 + event_id % 8 as decimal(18,1)) as string) end as temperatura_c,
       case when event_id % 19 = 0 then '' else cast(cast(3 + event_id % 3 as decimal(18,2)) as string) end as gordura_pct,
       cast(cast(3 + event_id % 2 as decimal(18,2)) as string) as proteina_pct,
       cast(cast(14 + event_id % 7 as decimal(18,2)) as string) as acidez,
       1 as _batch
from events where event_id % 3 = 0
""",
    "raw_coletas_b": """
select cast(event_id as string) as collection_id, cast(user_id as string) as farm_id, cast(user_id % 25 as string) as route_id,
       case when event_id % 40 = 7 then 'n/d' else concat(substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 6, 2), '-', substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 9, 2), '-', substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 1, 4)) end as collection_date,
       replace(cast(cast(case when event_id % 100 = 0 then -value else value end as decimal(18,2)) as string), '.', ',') as collected_liters,
       case when event_id % 17 = 0 then '' else replace(cast(cast(2 + event_id % 8 as decimal(18,1)) as string), '.', ',') end as temperature_c,
       case when event_id % 19 = 0 then '' else replace(cast(cast(3 + event_id % 3 as decimal(18,2)) as string), '.', ',') end as fat_pct,
       replace(cast(cast(3 + event_id % 2 as decimal(18,2)) as string), '.', ',') as protein_pct,
       replace(cast(cast(14 + event_id % 7 as decimal(18,2)) as string), '.', ',') as acidity,
       1 as _batch
from events where event_id % 3 = 1 or event_id % 60 = 0
""",
    "raw_coletas_c": """
select cast(event_id as string) as c_coleta_id, cast(user_id as string) as c_id_fazenda, cast(user_id % 25 as string) as c_id_rota,
       case when event_id % 40 = 7 then 'n/d' when event_id % 2 = 0 then cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string)
            else concat(substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 9, 2), '/', substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 6, 2), '/', substr(cast(cast(ts as date) + cast(event_id % 5 * 17 as int) as string), 1, 4)) end as c_data,
       cast(cast(case when event_id % 100 = 0 then -value else value end as decimal(18,2)) as string) as c_volume,
       case when event_id % 17 = 0 then '' else cast(cast(2 + event_id % 8 as decimal(18,1)) as string) end as c_temperatura,
       case when event_id % 19 = 0 then '' else cast(cast(3 + event_id % 3 as decimal(18,2)) as string) end as c_gordura,
       cast(cast(3 + event_id % 2 as decimal(18,2)) as string) as c_proteina,
       cast(cast(14 + event_id % 7 as decimal(18,2)) as string) as c_acidez,
       case event_id % 3 when 0 then '' when 1 then 'obs 1' else 'obs 2' end as c_observacao,
       2 as _batch
from events where event_id % 3 = 2 or event_id % 90 = 0
""",
    "raw_produtos": """
select cast(p_partkey as string) as id_produto, concat(' ', p_name) as nome_produto, p_type as categoria,
       case p_partkey % 4 when 0 then 'L' when 1 then 'kg' when 2 then 'un ' else 'cx' end as unidade,
       case when p_partkey % 33 = 0 then '0' when p_partkey % 41 = 0 then '' else cast(cast(p_retailprice as decimal(18,2)) as string) end as preco_venda,
       cast(cast(1 + p_size as decimal(18,2)) as string) as custo_unitario,
       case p_partkey % 4 when 0 then 'Não' when 1 then 'SIM' else 'sim' end as ativo,
       1 as _batch
from part
""",
    "raw_producao": """
select cast(l_orderkey * 10 + l_linenumber as string) as id_producao, cast(l_partkey as string) as id_produto,
       case when l_suppkey % 25 = 0 then '07/08/1998' when l_suppkey % 25 = 13 then '1998.07.08' else cast(cast(l_shipdate as date) as string) end as data_producao,
       case l_suppkey % 4 when 0 then 'Linha A' when 1 then 'linha  a' when 2 then 'LINHA   B' else 'Linha  C  x' end as linha_producao,
       cast(cast(cast(l_quantity as decimal(18,2)) * 100 as decimal(18,2)) as string) as volume_entrada_litros,
       cast(cast(cast(l_quantity as decimal(18,2)) * (70 + l_suppkey % 29) as decimal(18,2)) as string) as volume_saida,
       case when l_partkey % 20 = 0 then '' else cast(cast(l_extendedprice as decimal(18,2)) as string) end as custo_total,
       concat('L', cast(l_orderkey as string)) as lote,
       cast(cast(l_shipdate as date) + 180 as string) as validade,
       1 as _batch
from lineitem
""",
    "raw_clientes": """
select cast(c_custkey as string) as id_cliente, concat(c_name, ' ') as nome_cliente,
       case when c_custkey % 3 = 0 then lower(c_mktsegment) else concat(c_mktsegment, ' ') end as segmento,
       concat('E', cast(c_nationkey as string)) as estado,
       case when c_custkey % 12 = 0 then '' else concat('Cidade ', cast(c_custkey % 50 as string)) end as cidade,
       case when c_custkey % 10 = 0 then '' else concat('DOC/', cast(c_custkey as string)) end as cnpj,
       case c_custkey % 4 when 0 then 'NÃO' when 1 then 'Sim' else 'sim' end as ativo,
       1 as _batch
from customer
""",
    "raw_pedidos": """
select cast(o_orderkey as string) as id_pedido, cast(o_custkey as string) as id_cliente,
       case when o_orderkey % 25 = 0
            then concat(substr(cast(cast(o_orderdate as date) as string), 9, 2), '/', substr(cast(cast(o_orderdate as date) as string), 6, 2), '/', substr(cast(cast(o_orderdate as date) as string), 1, 4))
            when o_orderkey % 25 = 9 then '' else cast(cast(o_orderdate as date) as string) end as data_pedido,
       case when b._batch = 2 and o_orderkey % 150 = 0 then 'CANCELADO'
            when o_orderkey % 700 = 353 then 'Em trânsito' when o_orderstatus = 'F' then 'Faturado' when o_orderstatus = 'O' then ' entregue'
            when o_orderkey % 2 = 0 then 'Em separação' else 'Cancelado' end as status,
       case o_orderkey % 3 when 0 then 'Balcao' when 1 then 'telefone' else 'Site' end as canal,
       case when o_orderkey % 7 = 0 then '' else cast(cast(o_orderkey % 16 as decimal(18,2)) as string) end as desconto_pct,
       b._batch as _batch
from orders cross join (select 1 as _batch union all select 2 as _batch) b
where b._batch = 1 or o_orderkey % 50 = 0
""",
    "raw_itens_pedido": """
select cast(l_orderkey * 10 + l_linenumber as string) as id_item, cast(l_orderkey as string) as id_pedido, cast(l_partkey as string) as id_produto,
       cast(cast(l_quantity as int) as string) as quantidade,
       cast(cast(case when (l_orderkey + l_partkey) % 200 = 0 then -l_extendedprice else l_extendedprice end as decimal(18,2)) as string) as preco_unitario,
       case when (l_orderkey + l_partkey) % 33 = 0 then ''
            else cast(cast(cast(l_quantity as decimal(18,2)) * cast(l_extendedprice as decimal(18,2)) as decimal(18,2)) as string) end as valor_total,
       1 as _batch
from lineitem
""",
    "raw_entregas": """
select cast(o_orderkey as string) as id_entrega, cast(o_orderkey as string) as id_pedido, cast(o_custkey % 25 as string) as id_rota,
       case when o_orderkey % 26 = 0 then '09/10/1999' when o_orderkey % 26 = 5 then 'a definir' else cast(cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as string) end as data_prevista,
       case when o_orderkey % 20 = 0 then '' else cast(cast(o_orderdate as date) + cast(o_orderkey % 5 + o_custkey % 13 - 2 as int) as string) end as data_realizada,
       case o_orderkey % 4 when 0 then 'Pendente' when 1 then 'devolvido' when 2 then 'ENTREGUE' else ' Entregue' end as status_entrega,
       case when o_orderkey % 14 = 0 then '' else cast(cast(20 + o_custkey % 400 as decimal(18,1)) as string) end as km_percorrido,
       case when o_orderkey % 16 = 0 then '' else cast(cast(cast(o_totalprice as decimal(18,2)) * 0.01 as decimal(18,2)) as string) end as custo_frete,
       case when o_orderkey % 5 < 3 then '' when o_orderkey % 5 = 3 then 'Oc 1' else 'Oc 2' end as ocorrencia,
       1 as _batch
from orders
""",
    "raw_custos_operacionais": """
select cast(o_orderkey as string) as id_custo,
       case when o_orderkey % 800 = 401 then 'Marketing' when o_orderkey % 800 = 402 then 'coleta' else case o_custkey % 5 when 0 then 'Coleta' when 1 then 'Produção ' when 2 then 'Logística' when 3 then 'Comercial' else 'Administrativo' end end as centro_custo,
       case o_orderkey % 4 when 0 then 'Fixo' when 1 then 'variável' when 2 then 'FIXO' else 'VARIÁVEL' end as tipo_custo,
       case when o_orderkey % 20 = 0 then '' else o_orderpriority end as descricao,
       cast(cast(case when o_orderkey % 90 = 0 then 0 else o_totalprice end as decimal(18,2)) as string) as valor,
       case when o_orderkey % 25 = 1 then '01/02/1997' when o_orderkey % 25 = 11 then '31-12-1997' else cast(cast(o_orderdate as date) as string) end as data_referencia,
       substr(cast(cast(o_orderdate as date) as string), 1, 7) as competencia,
       1 as _batch
from orders
""",
    "raw_perdas": """
select cast(l_orderkey * 10 + l_linenumber as string) as id_perda,
       if(l_partkey % 60 = 7, 'Envase', case l_suppkey % 4 when 0 then 'Coleta' when 1 then 'Produção' when 2 then ' Estoque' else 'Transporte' end) as etapa,
       concat('Tipo ', l_returnflag, cast(l_partkey % 5 as string)) as tipo_perda,
       case when l_partkey % 25 = 0 then '03/04/1999' when l_partkey % 25 = 13 then 'n/d' else cast(cast(l_shipdate as date) as string) end as data_perda,
       case when l_partkey % 20 = 1 then '' else cast(cast(l_quantity as decimal(18,2)) as string) end as volume_litros_ou_kg,
       case when l_partkey % 12 = 1 then '' else cast(cast(l_extendedprice as decimal(18,2)) as string) end as valor_estimado,
       case when l_suppkey % 4 = 0 then cast(l_suppkey as string) else '' end as id_cooperado,
       case when l_suppkey % 4 = 1 then cast(l_orderkey * 10 + l_linenumber as string) else '' end as id_producao,
       case when l_suppkey % 4 = 3 then cast(l_orderkey as string) else '' end as id_entrega,
       case when l_partkey % 7 = 0 then '' else concat('Perda ', l_returnflag) end as descricao,
       1 as _batch
from lineitem
""",
}
