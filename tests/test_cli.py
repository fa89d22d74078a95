"""The command line runs the pipeline steps."""

import os

from curdle.__main__ import main
from curdle.plans import pipeline


def test_cli_bronze_then_silver(spark, scratch, capsys):
    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw)
    with open(os.path.join(raw, "rotas.csv"), "w", encoding="utf-8") as f:
        f.write("id_rota,nome_rota,municipio_origem,km_total,veiculo_tipo,ativa\n1, R1 ,T,10.5,Tanque,sim\n")
    main(["bronze", "--raw", raw, "--batch", "1", "--warehouse", wh])
    assert '"status": "SUCCESS"' in capsys.readouterr().out
    main(["silver", "--warehouse", wh])
    row = pipeline.read_model(spark, wh, "silver", "stg_rotas").first()
    assert (row.id_rota, row.nome_rota, float(row.km_total), row.ativo, row._dq_ok) == (1, "R1", 10.5, True, True)
