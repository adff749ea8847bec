"""The six feeds with nested arrays."""

from __future__ import annotations

from marketloom.plans.spec import (
    FeedSpec,
    FxRule,
    Output,
    Sink,
    dated,
    part_of,
    record,
    renamed,
    same,
    strings,
)

# Row types of the raw feeds and of the arrays inside them.
MONEY = record("currency string, amount double")
UNIT_MONEY = record("currencyAmount double, currencyUnit string")
PRICE = record("amount double, currency string")
QUANTITY = record("unit string, amount double")
MEASURE = record("unitOfMeasure string, measurementValue double")

ADDRESS = record(
    strings("name address1 address2 address3 address4 city state postalCode country")
)
ORDER_ITEM = record(
    strings("upc offerId productName sku condition imageUrl"),
    unitPrice=MONEY,
    commission=MONEY,
    unitPriceWithoutTax=MONEY,
)
CHARGE = record(
    strings("chargeType chargeName"),
    chargeAmount=MONEY,
    tax=record("taxName string", taxAmount=MONEY),
)
ORDER_LINE = record(
    """lineNumber string, primeLineNumber string, coLineNumber string, statusDate date,
    shippingMethod string, soPrimeLineSubLineNo string, promiseDeliveryDate timestamp_ntz,
    isMSIEnabled string, refund string""",
    item=ORDER_ITEM,
    charges=record("", charge=CHARGE),
    orderLineQuantity=record("unitOfMeasurement string, amount double"),
    seller=record(strings("id name shipNodeType")),
    fulfillment=record(
        """fulfillmentOption string, shipMethod string, pickUpDateTime timestamp_ntz,
        shippingProgramType string"""
    ),
    orderLineStatuses=record("orderLineStatus string"),
)
ORDERS = record(
    """statusCodeFilter string, shipNodeType string, purchaseOrderId string,
    customerOrderId string, customerEmailId string, orderType string,
    orderDate timestamp_ntz, billingInfo string, totalLines bigint, totalQuantity bigint,
    shipNode string, rfc string, paymentMethod string, cfdi string""",
    shippingInfo=record(
        """phone string, estimatedDeliveryDate date, estimatedShipDate date,
        methodCode string""",
        postalAddress=ADDRESS,
    ),
    shipments=record(
        strings(
            "shipmentNo status packageNo isSellerOwnedShipment carrier trackingNumber"
            " trackingUrl shipmentAdditionalDate"
        ),
        shipmentLines=record("primeLineNo string, shipmentLineNo string, quantity double"),
    ),
    orderTotal=MONEY,
    orderLines=record("", orderLine=ORDER_LINE),
)

RETURN_CHARGE = record(
    strings("chargeCategory chargeName isDiscount isBillable excessCharge references"),
    chargePerUnit=UNIT_MONEY,
    tax=record("taxName string", excessTax=UNIT_MONEY, taxPerUnit=UNIT_MONEY),
)
RETURN_LINE = record(
    """returnOrderLineNumber string, salesOrderLineNumber string, returnReason string,
    purchaseOrderId string, purchaseOrderLineNumber string, isReturnForException string,
    itemReturnSettings string, cancellableQty string, returnExpectedFlag string,
    isFastReplacement string, isKeepIt string, lastItem string, refundedQty double,
    rechargeableQty string, refundChannel string, returnTrackingDetail string,
    status string, statusTime timestamp_ntz, currentDeliveryStatus string,
    currentRefundStatus string""",
    item=record("sku string, productName string", itemWeight=MEASURE),
    charges=RETURN_CHARGE,
    unitPrice=UNIT_MONEY,
    quantity=MEASURE,
    chargeTotals=record("name string", value=UNIT_MONEY),
)
RETURNS = record(
    """returnOrderId string, customerEmailId string, customerOrderId string,
    returnOrderDate timestamp_ntz, returnByDate timestamp_ntz, refundMode string,
    returnLineGroups string""",
    customerName=record("firstName string, lastName string"),
    totalRefundAmount=UNIT_MONEY,
    returnChannel=record("channelName string"),
    returnOrderLines=RETURN_LINE,
)

INVENTORY = record(
    "sku string",
    nodes=record("shipNode string", inputQty=QUANTITY, availToSellQty=QUANTITY),
)
SHIP_NODES = record(
    "sku string",
    shipNodes=record(
        "modifiedDate timestamp_ntz, availToSellQty bigint, onHandQty bigint, shipNodeType string"
    ),
)
UNPUBLISHED = record(
    """gtin string, offerStartDate date, marketTrending string, lifecycleStatus string,
    unpublishReasons string, conversionRate double, productName string, itemId string,
    customerRating double, pageViews bigint, unpublishedDate date, brand string,
    sku string, productType string, offerEndDate date, publishStatus string""",
    marketPrice=PRICE,
    gmvAmount=PRICE,
    price=PRICE,
)

ADDRESS_LINES = "address1 address2 address3 address4 city state"


def _order_outputs() -> tuple[Output, ...]:
    header = same(
        "statusCodeFilter shipNodeType purchaseOrderId customerOrderId customerEmailId orderType"
    )
    shipping = part_of("shippingInfo", "phone estimatedDeliveryDate estimatedShipDate methodCode")
    address = (
        renamed(full_name="postalAddress.name")
        + part_of("postalAddress", ADDRESS_LINES, "ship_")
        + renamed(ship_postal_code="postalAddress.postalCode", ship_country="postalAddress.country")
    )
    line = part_of("orderLine", "lineNumber primeLineNumber coLineNumber")
    item = part_of("item", "upc offerId productName sku condition imageUrl")
    prices = tuple(
        output
        for parent in ("unitPrice", "commission", "unitPriceWithoutTax")
        for output in part_of(parent, "currency amount", f"{parent}_")
    )
    charge = (
        part_of("charge", "chargeType chargeName")
        + part_of("chargeAmount", "currency amount", "chargeAmount_")
        + part_of("charge", "tax")
        + part_of("tax", "taxName")
        + part_of("taxAmount", "currency amount", "tax_")
    )
    line_tail = (
        part_of("orderLineQuantity", "unitOfMeasurement amount", "orderLineQuantity_")
        + part_of("orderLine", "statusDate")
        + part_of("orderLineStatuses", "orderLineStatus")
        + part_of(
            "orderLine",
            "shippingMethod soPrimeLineSubLineNo promiseDeliveryDate isMSIEnabled refund",
        )
        + part_of("seller", "id name shipNodeType", "seller_")
        + part_of("fulfillment", "fulfillmentOption shipMethod pickUpDateTime shippingProgramType")
    )
    shipment = (
        part_of("shipmentLines", "primeLineNo shipmentLineNo")
        + renamed(shipment_quantity="shipmentLines.quantity")
        + part_of(
            "shipments",
            "shipmentNo status packageNo isSellerOwnedShipment carrier trackingNumber"
            " trackingUrl shipmentAdditionalDate",
        )
    )
    return (
        header
        + dated("orderDate")
        + shipping
        + address
        + same("billingInfo totalLines totalQuantity")
        + line
        + item
        + prices
        + charge
        + line_tail
        + same("shipNode")
        + shipment
        + part_of("orderTotal", "currency amount", "orderTotal_")
        + same("rfc paymentMethod cfdi")
    )


def _return_head() -> tuple[Output, ...]:
    return (
        same("returnOrderId customerEmailId")
        + part_of("customerName", "firstName lastName")
        + same("customerOrderId")
        + dated("returnOrderDate returnByDate")
        + same("refundMode")
        + part_of("totalRefundAmount", "currencyAmount currencyUnit", "totalRefundAmount_")
        + same("returnLineGroups")
    )


def _return_line_outputs() -> tuple[Output, ...]:
    amount = "currencyAmount currencyUnit"
    measure = "unitOfMeasure measurementValue"
    return (
        _return_head()
        + part_of(
            "returnOrderLines",
            "returnOrderLineNumber salesOrderLineNumber returnReason purchaseOrderId"
            " purchaseOrderLineNumber isReturnForException",
        )
        + part_of("item", "sku productName")
        + part_of("itemWeight", measure, "itemWeight_")
        + part_of("charges", "chargeCategory chargeName")
        + part_of("chargePerUnit", amount, "chargePerUnit_")
        + part_of("charges", "isDiscount isBillable tax excessCharge")
        + renamed(charges_references="charges.references")
        + part_of("excessTax", amount, "excessTax_")
        + part_of("tax", "taxName")
        + part_of("taxPerUnit", amount, "taxPerUnit_")
        + part_of("unitPrice", amount, "unitPrice_")
        + part_of("returnOrderLines", "itemReturnSettings")
        + part_of("chargeTotals", "name", "chargeTotals_")
        + part_of("value", amount, "chargeTotals_value_")
        + part_of("returnOrderLines", "cancellableQty")
        + part_of("quantity", measure, "quantity_")
        + part_of(
            "returnOrderLines",
            "returnExpectedFlag isFastReplacement isKeepIt lastItem refundedQty"
            " rechargeableQty refundChannel returnTrackingDetail status statusTime"
            " currentDeliveryStatus currentRefundStatus",
        )
        + part_of("returnChannel", "channelName")
    )


def nested_feeds(marketplace: str) -> list[FeedSpec]:
    """Specifications of the nested feeds of one marketplace."""
    refund_rate = {"date": "returnOrderDate", "currency": "totalRefundAmount_currencyUnit"}
    return [
        FeedSpec(
            name="m06_inventory",
            feed="inventory",
            like=f"%{marketplace}%inventory",
            not_like=(f"%{marketplace}%wfsinventory",),
            raw_schema=INVENTORY,
            unnest=("nodes", "nodes.inputQty", "nodes.availToSellQty"),
            outputs=same("sku")
            + part_of("nodes", "shipNode")
            + part_of("inputQty", "unit amount", "inputQty_")
            + part_of("availToSellQty", "unit amount", "availToSellQty_"),
            keys=("sku",),
            scope="global",
            sink=Sink(("sku",)),
        ),
        FeedSpec(
            name="m12_orders",
            feed="orders",
            like=f"%{marketplace}%orders",
            raw_schema=ORDERS,
            unnest=(
                "orderLines",
                "orderLines.orderLine",
                "orderLine.item",
                "orderLine.charges",
                "charges.charge",
                "shippingInfo",
                "shippingInfo.postalAddress",
                "shipments",
                "shipments.shipmentLines",
                "orderTotal",
                "orderLine.orderLineQuantity",
                "orderLine.seller",
                "orderLine.fulfillment",
                "orderLine.orderLineStatuses",
                "item.unitPrice",
                "item.commission",
                "item.unitPriceWithoutTax",
                "charge.chargeAmount",
                "charge.tax",
                "tax.taxAmount",
            ),
            outputs=_order_outputs(),
            keys=tuple(
                "purchaseOrderId customerOrderId lineNumber chargeType sku orderDate"
                " productName".split()
            ),
            scope="global",
            fx=FxRule("orderDate", "chargeAmount_currency", leading=True),
            sink=Sink(("purchaseOrderId", "customerOrderId", "chargeType", "sku"), "orderDate"),
        ),
        FeedSpec(
            name="m18_returns",
            feed="returns",
            like=f"%{marketplace}%returns",
            raw_schema=RETURNS,
            unnest=("customerName", "totalRefundAmount", "returnChannel"),
            outputs=_return_head()
            + same("returnOrderLines")
            + part_of("returnChannel", "channelName"),
            keys=("returnOrderId", "customerOrderId"),
            ties="one",
            tie_break=("returnOrderDate",),
            scope="global",
            fx=FxRule(**refund_rate, leading=True),
            sink=Sink(("returnOrderId", "customerOrderId"), "returnOrderDate"),
        ),
        FeedSpec(
            name="m19_returns_order_lines",
            feed="returns",
            like=f"%{marketplace}%returns",
            raw_schema=RETURNS,
            unnest=(
                "returnOrderLines",
                "returnOrderLines.chargeTotals",
                "customerName",
                "totalRefundAmount",
                "returnChannel",
                "returnOrderLines.item",
                "returnOrderLines.charges",
                "returnOrderLines.unitPrice",
                "returnOrderLines.quantity",
                "item.itemWeight",
                "charges.chargePerUnit",
                "charges.tax",
                "tax.excessTax",
                "tax.taxPerUnit",
                "chargeTotals.value",
            ),
            outputs=_return_line_outputs(),
            keys=("returnOrderId", "customerOrderId", "chargeTotals_name"),
            ties="one",
            tie_break=("returnOrderLines.returnOrderLineNumber",),
            scope="global",
            fx=FxRule(**refund_rate, leading=True, null_code_when_off=True),
            sink=Sink(
                ("returnOrderId", "customerOrderId", "chargeTotals_name"), "returnOrderDate"
            ),
        ),
        FeedSpec(
            name="m25_unpublished_items",
            feed="unpublisheditemsreport",
            like=f"%{marketplace}%unpublisheditemsreport",
            raw_schema=UNPUBLISHED,
            unnest=("marketPrice", "gmvAmount", "price"),
            outputs=same("gtin")
            + part_of("marketPrice", "amount currency", "marketPrice_")
            + same(
                "offerStartDate marketTrending lifecycleStatus unpublishReasons"
                " conversionRate productName"
            )
            + part_of("gmvAmount", "amount currency", "gmvAmount_")
            + same("itemId customerRating pageViews")
            + part_of("price", "amount currency", "price_")
            + same("unpublishedDate")
            + renamed(Item_Brand="brand")
            + same("sku productType offerEndDate publishStatus"),
            keys=("itemId", "sku"),
            scope="global",
            sink=Sink(("itemId", "sku"), "offerStartDate"),
        ),
        FeedSpec(
            name="m26_wfs_inventory",
            feed="wfsinventory",
            like=f"%{marketplace}%wfsinventory",
            raw_schema=SHIP_NODES,
            unnest=("shipNodes",),
            outputs=same("sku")
            + (Output("modifiedDate", "shipNodes.modifiedDate", "date"),)
            + part_of("shipNodes", "availToSellQty onHandQty shipNodeType"),
            keys=("sku",),
            scope="global",
            sink=Sink(("sku",), "modifiedDate"),
        ),
    ]
