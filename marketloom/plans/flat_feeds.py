"""The twenty flat report feeds.

Each feed is its raw column list, its business key and its table layout; the output
is the raw list in the same order, a scalar ``brand`` becoming ``Item_Brand``.
"""

from __future__ import annotations

from marketloom.plans.spec import (
    BATCH_DATE,
    FeedSpec,
    FxRule,
    Output,
    Sink,
    record,
    renamed,
)

# The raw columns of the feeds, in output order. ``{label}`` is the
# marketplace's own label inside column names.
BUY_BOX = """
    ReportDate date, Seller_Id string, Sku string, Item_ID string, Product_Name string,
    Product_Category string, Seller_Name string, Seller_Item_Price double,
    Seller_Ship_Price double, IsSellerBuyBoxWinner string, Buybox_Seller_ID string,
    Buybox_Item_Price double, Buybox_Ship_Price double, Offer2_Seller_ID string,
    Offer2_Item_Price double, Offer2_Ship_Price double, Offer3_Seller_ID string,
    Offer3_Item_Price double, Offer3_Ship_Price double, Offer4_Seller_ID string,
    Offer4_Item_Price double, Offer4_Ship_Price double"""
CPA = """
    SKU string, SKU_OPT_IN string, PRODUCT_NAME string, CURRENCY string, PRICE double,
    SHIP_PRICE double"""
CAP = "ReportDate date, PARTNER_ID string," + CPA
DEFECT = """
    OrderPlacedDt date, ActualDeliveryDate date, CancelDate date, DestinationState string,
    EstimatedDeliveryDate date, SalesOrder string, ReturnDate date, TrackingNum string,
    Carrier string, CatlgItemId string, ReturnReason string, OfferId string, PoNum string,
    LegacySlrId string, DefectType string, CancelReason string"""
INVENTORY_FLAT = """
    ReportDateTime timestamp_ntz, SKU string, Item_ID string, Product_Name string,
    Ship_Node_ID string, Ship_Node_Name string, Input_Quantity bigint,
    AvailToSell_Quantity bigint"""
PERFORMANCE_HEAD = """
    Product_Name string, Item_ID string, SKU_ID string, Super_Department string,
    Department string, Category string, Sub_Category string, Brand string, GMV double,
    Commission double, """
PERFORMANCE_TAIL = """
    Authorized_Orders bigint, Authorized_Units bigint, Authorized_Sales double,
    Total_LY_GMV double, Product_Level_Pageviews bigint,
    Product_Level_Conversion_Rate double, Refunded_Sales double"""
PERFORMANCE = (
    PERFORMANCE_HEAD
    + """GMV_Commission double, AUR double, Total_Units bigint, legacySlrId string,
    Cancelled_Units bigint, Cancelled_Sales double, Item_Conversion_Rate double,
    Base_Item_Id string, Total_Product_Visits bigint, GMV_Comp__Percent double,"""
    + PERFORMANCE_TAIL
)
PERFORMANCE_ON_REQUEST = (
    PERFORMANCE_HEAD
    + """GMV_Minus_Commission double, AUR double, Total_Units_Sold bigint,
    Cancelled_Units bigint, Cancelled_Sales double, Item_Conversion_Rate double,
    Base_Item_Id string, Total_Product_Visits bigint, GMV_Comp_WithSpacePercent double,"""
    + PERFORMANCE_TAIL
)
ITEM = """
    ReportDate date, PARTNER_ID string, SKU string, PRODUCT_NAME string,
    PRODUCT_CATEGORY string, PRICE double, CURRENCY string, BUY_BOX_ITEM_PRICE double,
    BUY_BOX_SHIPPING_PRICE double, PUBLISH_STATUS string, STATUS_CHANGE_REASON string,
    LIFECYCLE_STATUS string, INVENTORY_COUNT bigint, SHIP_METHODS string, WPID string,
    ITEM_ID string, GTIN string, UPC string, PRIMARY_IMAGE_URL string, SHELF_NAME string,
    PRIMARY_CAT_PATH string, OFFER_START_DATE date, OFFER_END_DATE date,
    ITEM_CREATION_DATE date, ITEM_LAST_UPDATED timestamp_ntz, ITEM_PAGE_URL string,
    REVIEWS_COUNT bigint, AVERAGE_RATING double, SEARCHABLE__ string,
    COMPETITOR_URL string, COMPETITOR_PRICE double, COMPETITOR_SHIP_PRICE double,
    COMPETITOR_LAST_DATE_FETCHED date, BRAND string, PRODUCT_TAX_CODE string, MSRP double,
    SHIPPING_WEIGHT double, SHIPPING_WEIGHT_UNIT string, FULFILLMENT_LAG_TIME bigint,
    FULFILLMENT_TYPE string, WFS_SALES_RESTRICTION string"""
ITEM_ON_REQUEST = """
    ReportDateTime timestamp_ntz, SKU string, Item_ID string, Product_Name string,
    Lifecycle_Status string, Publish_Status string, Status_Change_Reason string,
    Product_Category string, Price double, Currency string, Buy_Box_Item_Price double,
    Buy_Box_Shipping_Price double, MSRP double, Product_Tax_Code string,
    Ship_Methods string, Shipping_Weight double, Shipping_Weight_Unit string,
    Fulfillment_Lag_Time bigint, Fulfillment_Type string, WFS_Sales_Restriction string,
    WPID string, GTIN string, UPC string, Item_Page_URL string, Shelf_Name string,
    Primary_Category_Path string, Brand string, Offer_Start_Date date,
    Offer_End_Date date, Item_Creation_Date date, Item_Last_Updated timestamp_ntz,
    Reviews_Count bigint, Average_Rating double, Searchable__ string,
    Competitor_URL string, Competitor_Price double, Competitor_Ship_Price double,
    Competitor_Last_Date_Fetched date"""
PROMO_ON_REQUEST = """
    SKU string, Item_ID string, Product_Name string, Product_Category string,
    Promo_ID string, Promo_Effective_Date date, Promo_Expiration_Date date,
    Current_Price double, Current_Price_Currency string, Comparison_Price double,
    Comparison_Price_Currency string, Promotion_Type string, Promotion_Status string"""
PROMOTIONS = """
    ReportDate date, Partner_ID string, SKU string, Item_ID string, Product_Name string,
    Product_Category string, Promo_ID string, Promo_Effective_Date date,
    Promo_Expiration_Date date, Current_Price double, Current_Price_Currency string,
    Comparison_Price double, Comparison_Price_Currency string, Promo_Type string,
    Promo_Status string"""
RECONCILIATION = """
    ReportDate date, {label}_dot_com_Order__hash string,
    {label}_dot_com_Order_Line__hash string, {label}_dot_com_PO__hash string,
    {label}_dot_com_P_dot_O_dot__Line__hash string, Partner_Order__hash string,
    Transaction_Type string, Transaction_Date_Time timestamp_ntz, Shipped_Qty bigint,
    Partner_Item_ID string, Partner_GTIN string, Partner_Item_name string,
    Product_tax_code string, Shipping_tax_code string, Gift_wrap_tax_code string,
    Ship_to_state string, Ship_to_county string, County_Code string, Ship_to_city string,
    Zip_code string, shipping_Underscore_method string,
    Total_tender_to__slash__from_customer double, Payable_to_Partner_from_Sale double,
    Commission_from_Sale double, Commission_Rate double, Gross_Sales_Revenue double,
    Refunded_Retail_Sales double, Sales_refund_for_Escalation double,
    Gross_Shipping_Revenue double, Gross_Shipping_Refunded double,
    Shipping_refund_for_Escalation double, Net_Shipping_Revenue double,
    Gross_Fee_Revenue double, Gross_Fee_Refunded double, Fee_refund_for_Escalation double,
    Net_Fee_Revenue double, Gift_Wrap_Quantity bigint, Gross_Gift_Dash_Wrap_Revenue double,
    Gross_Gift_Dash_Wrap_Refunded double, Gift_wrap_refund_for_Escalation double,
    Net_Gift_Wrap_Revenue double, Tax_on_Sales_Revenue double,
    Tax_on_Shipping_Revenue double, Tax_on_Gift_Dash_Wrap_Revenue double,
    Tax_on_Fee_Revenue double, Effective_tax_rate double, Tax_on_Refunded_Sales double,
    Tax_on_Shipping_Refund double, Tax_on_Gift_Dash_Wrap_Refund double,
    Tax_on_Fee_Refund double, Tax_on_Sales_refund_for_Escalation double,
    Tax_on_Shipping_Refund_for_Escalation double,
    Tax_on_Gift_Dash_Wrap_Refund_for_escalation double,
    Tax_on_Fee_Refund_for_escalation double, Total_NET_Tax_Collected double,
    Tax_Withheld double, Adjustment_Description string, Adjustment_Code string,
    Original_Item_price double, Original_Commission_Amount double, Product_Type string,
    Spec_Category string, Contract_Category string, Flex_Commission_Rule string,
    Return_Reason_Code string, Return_Reason_Description string, Fee_Withheld_Flag string,
    Fulfillment_Type string"""
RETURN_ITEM_OVERRIDES = """
    ReportDate date, partnerId string, SKU string, Keep_It string,
    Return_Restricted string, Restriction_Reason string,
    Return_Center_Brace_Alias_Brace string"""
RETURN_OVERRIDES = """
    SKU string, Keep_It string, Return_Restricted string, Restriction_Reason string,
    Return_Center string, Publish_Status string"""
SHIPPING_CONFIGURATION_ON_REQUEST = """
    SKU string, Item_ID string, Product_Name string, Publish_Status string,
    Lifecycle_Status string, Ship_Node_ID string, Ship_Node_Name string,
    Ship_Node_Type string, Template_ID string, Template_Name string, Template_Type string"""
SHIPPING_CONFIGURATION = "ReportDate date," + SHIPPING_CONFIGURATION_ON_REQUEST
SHIPPING_PROGRAM = """
    Product_Name string, Item_ID string, SKU string, Publish_Status string,
    Lifecycle_Status string, Program_Participation string, Template_ID string,
    Template_Type string, Coverage_Areas string"""
SHIPPING_PROGRAM_ON_REQUEST = """
    SKU string, Item_ID string, Product_Name string, Publish_Status string,
    Lifecycle_Status string, Program_Participation string, Template_ID string,
    Template_Type string, Coverage_Areas string"""
TOP_TRENDING = """
    ReportDate date, DepartmentId string, TimeFrame string, departmentName string,
    isbn string, categoryName string, productName string, subCategoryName string,
    isTwoDayEligible string, itemId string, totalOffers bigint, issn string,
    superDepartmentName string, existsForSeller string, rank bigint, brand string"""


def _outputs(names: list[str]) -> tuple[Output, ...]:
    return tuple(
        Output("Item_Brand" if name.lower() == "brand" else name, name) for name in names
    )


def flat_feeds(marketplace: str, label: str) -> list[FeedSpec]:
    """Specifications of the flat feeds of one marketplace."""

    def feed(name, pattern, columns, keys, day=None, cluster=None, by_day=False, **more):
        raw = record(columns.format(label=label))
        keys = tuple(keys.format(label=label).split())
        return FeedSpec(
            name=name,
            feed=pattern.replace("%", ""),
            like=f"%{marketplace}%{pattern}",
            raw_schema=raw,
            outputs=_outputs(raw.names) + more.pop("derived", ()),
            keys=keys,
            sink=Sink(tuple(cluster.split()) if cluster else keys, day, by_day),
            **more,
        )

    batch_date = renamed(ReportDate=BATCH_DATE)
    placed_date = (Output("ReportDate", "OrderPlacedDt", "date"),)
    promo_date = (Output("ReportDate", "Promo_Effective_Date", "date"),)
    defect_cluster = "OrderPlacedDt TrackingNum CatlgItemId"
    po_key = (
        "{label}_dot_com_PO__hash {label}_dot_com_P_dot_O_dot__Line__hash"
        " Transaction_Type Adjustment_Code"
    )
    return [
        feed("m01_buy_box", "buyboxreport", BUY_BOX,
             "ReportDate Seller_Id Sku Item_ID", "ReportDate", "Seller_Id Sku Item_ID"),
        feed("m02_cap", "capreport", CAP, "SKU", "ReportDate"),
        feed("m03_cpa_on_request", "cpareportonrequest", CPA, "SKU"),
        feed("m04_cancellation_on_request", "cancellationreportonrequest", DEFECT,
             "TrackingNum CatlgItemId", "ReportDate", defect_cluster,
             after_batch_id=placed_date),
        feed("m05_delivery_defect_on_request", "delivery%defectreportonrequest", DEFECT,
             "TrackingNum CatlgItemId", "ReportDate", defect_cluster,
             after_batch_id=placed_date),
        feed("m07_inventory_on_request", "inventoryreportonrequest", INVENTORY_FLAT, "SKU",
             "ReportDateTime", by_day=True),
        feed("m08_item_performance", "itemperformancereport", PERFORMANCE,
             "Item_ID SKU_ID", "ReportDate", derived=batch_date),
        feed("m09_item_performance_on_request", "itemperformancereportonrequest",
             PERFORMANCE_ON_REQUEST, "Item_ID SKU_ID", "ReportDate", derived=batch_date),
        feed("m10_item", "itemreport", ITEM, "ITEM_ID SKU", "ReportDate", ties="one",
             tie_break=("ReportDate",), fx=FxRule("ReportDate", "CURRENCY")),
        feed("m11_item_on_request", "itemreportonrequest", ITEM_ON_REQUEST, "Item_ID SKU",
             "Item_Creation_Date", ties="one", tie_break=("ReportDateTime",),
             fx=FxRule("ReportDateTime", "Currency")),
        feed("m13_promo_on_request", "promoreportonrequest", PROMO_ON_REQUEST,
             "Item_ID SKU", "ReportDate", after_batch_id=promo_date),
        feed("m14_promotions", "promotionsreport", PROMOTIONS, "Partner_ID Item_ID SKU",
             "ReportDate", fx=FxRule("ReportDate", "Current_Price_Currency")),
        feed("m15_reconciliation", "reconciliationreport", RECONCILIATION, po_key,
             "ReportDate"),
        feed("m16_return_item_overrides", "returnitemoverridesreport",
             RETURN_ITEM_OVERRIDES, "partnerId SKU", "ReportDate"),
        feed("m17_return_overrides_on_request", "return%overridesreportonrequest",
             RETURN_OVERRIDES, "SKU"),
        feed("m20_shipping_configuration", "shippingconfigurationreport",
             SHIPPING_CONFIGURATION, "Item_ID SKU", "ReportDate"),
        feed("m21_shipping_configuration_on_request",
             "shipping%configurationreportonrequest", SHIPPING_CONFIGURATION_ON_REQUEST,
             "Item_ID SKU"),
        feed("m22_shipping_program", "shippingprogramreport", SHIPPING_PROGRAM,
             "Item_ID SKU", "ReportDate", derived=batch_date),
        feed("m23_shipping_program_on_request", "shipping%programreportonrequest",
             SHIPPING_PROGRAM_ON_REQUEST, "Item_ID SKU"),
        feed("m24_top_trending", "toptrendingitemsreport", TOP_TRENDING,
             "DepartmentId itemId", "ReportDate"),
    ]
