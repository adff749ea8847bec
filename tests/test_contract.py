"""The specifications against the feeds' contract, written down here a second time."""

import pytest

from fixtures.raw import SPECS

# Fixed values, compared without case: keys | folder field | cluster columns | rows of the
# newest batch that stay | scope of the ranking | unnested arrays | has exchange rates.
CONTRACT = {
    "m01": "ReportDate Seller_Id Sku Item_ID | ReportDate | Seller_Id Sku Item_ID | all | source | 0 |",
    "m02": "SKU | ReportDate | SKU | all | source | 0 |",
    "m03": "SKU | | SKU | all | source | 0 |",
    "m04": "TrackingNum CatlgItemId | ReportDate | OrderPlacedDt TrackingNum CatlgItemId | all | source | 0 |",
    "m05": "TrackingNum CatlgItemId | ReportDate | OrderPlacedDt TrackingNum CatlgItemId | all | source | 0 |",
    "m06": "sku | | sku | all | global | 3 |",
    "m07": "SKU | ReportDateTime_day | SKU | all | source | 0 |",
    "m08": "Item_ID SKU_ID | ReportDate | ITEM_ID SKU_ID | all | source | 0 |",
    "m09": "Item_ID SKU_ID | ReportDate | Item_ID SKU_ID | all | source | 0 |",
    "m10": "ITEM_ID SKU | ReportDate | ITEM_ID SKU | one | source | 0 | rates",
    "m11": "ITEM_ID SKU | Item_Creation_Date | Item_ID SKU | one | source | 0 | rates",
    "m12": "purchaseOrderId customerOrderId lineNumber chargeType sku orderDate productName | orderDate"
    " | purchaseOrderId customerOrderId chargeType sku | all | global | 20 | rates",
    "m13": "Item_ID SKU | ReportDate | Item_ID SKU | all | source | 0 |",
    "m14": "Partner_ID Item_ID SKU | ReportDate | Partner_ID Item_ID SKU | all | source | 0 | rates",
    "m15": "Mkt_dot_com_PO__hash Mkt_dot_com_P_dot_O_dot__Line__hash Transaction_Type Adjustment_Code | ReportDate"
    " | Mkt_dot_com_PO__hash Mkt_dot_com_P_dot_O_dot__Line__hash Transaction_Type Adjustment_Code | all | source | 0 |",
    "m16": "partnerId SKU | ReportDate | partnerId SKU | all | source | 0 |",
    "m17": "SKU | | SKU | all | source | 0 |",
    "m18": "returnOrderId customerOrderId | returnOrderDate | returnOrderId customerOrderId | one | global | 3 | rates",
    "m19": "returnOrderId customerOrderId chargeTotals_name | returnOrderDate"
    " | returnOrderId customerOrderId chargeTotals_name | one | global | 15 | rates",
    "m20": "Item_ID SKU | ReportDate | Item_ID SKU | all | source | 0 |",
    "m21": "Item_ID SKU | | Item_ID SKU | all | source | 0 |",
    "m22": "Item_ID SKU | ReportDate | Item_ID SKU | all | source | 0 |",
    "m23": "Item_ID SKU | | Item_ID SKU | all | source | 0 |",
    "m24": "DepartmentId itemId | ReportDate | DepartmentId itemId | all | source | 0 |",
    "m25": "itemId sku | offerStartDate | itemId sku | all | global | 3 |",
    "m26": "sku | modifiedDate | sku | all | global | 1 |",
}


@pytest.mark.parametrize("name", list(SPECS))
def test_specification(name):
    spec = SPECS[name]
    found = (
        " ".join(spec.keys), spec.sink.folder_column or "", " ".join(spec.sink.cluster_by),
        spec.ties, spec.scope, str(len(spec.unnest)), "rates" if spec.fx else "",
    )
    wanted = tuple(part.strip() for part in CONTRACT[name[:3]].split("|"))
    assert [x.lower() for x in found] == [x.lower() for x in wanted]


def test_every_feed_has_a_contract():
    assert sorted(name[:3] for name in SPECS) == sorted(CONTRACT)
