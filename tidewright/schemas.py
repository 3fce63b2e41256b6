"""Declared schemas. Nothing is inferred from data files."""

from pyspark.sql import types as T

# The fields of a raw movie document and of the silver movie table.
# Id, RunTime and genre ids are wider than the two-byte numbers of the raw format, so that keys of
# large tables fit.
GENRE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])

MOVIE = T.StructType(
    [
        T.StructField("BackdropUrl", T.StringType()),
        T.StructField("Budget", T.DoubleType()),
        T.StructField("CreatedBy", T.StringType()),
        T.StructField("CreatedDate", T.StringType()),
        T.StructField("Id", T.LongType()),
        T.StructField("ImdbUrl", T.StringType()),
        T.StructField("OriginalLanguage", T.StringType()),
        T.StructField("Overview", T.StringType()),
        T.StructField("PosterUrl", T.StringType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("ReleaseDate", T.StringType()),
        T.StructField("Revenue", T.DoubleType()),
        T.StructField("RunTime", T.IntegerType()),
        T.StructField("Tagline", T.StringType()),
        T.StructField("Title", T.StringType()),
        T.StructField("TmdbUrl", T.StringType()),
        T.StructField("UpdatedBy", T.StringType()),
        T.StructField("UpdatedDate", T.StringType()),
        T.StructField("genres", T.ArrayType(GENRE)),
    ]
)

MOVIE_DOCUMENT = T.StructType([T.StructField("movie", T.ArrayType(MOVIE))])

BRONZE = T.StructType(
    [
        T.StructField("value", MOVIE),
        T.StructField("datasource", T.StringType()),
        T.StructField("ingesttime", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("p_ingestdate", T.DateType()),
    ]
)

SILVER_MOVIE = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("Budget", T.DoubleType()),
        T.StructField("Revenue", T.DoubleType()),
        T.StructField("RunTime", T.IntegerType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Overview", T.StringType()),
        T.StructField("Tagline", T.StringType()),
        T.StructField("ImdbUrl", T.StringType()),
        T.StructField("TmdbUrl", T.StringType()),
        T.StructField("PosterUrl", T.StringType()),
        T.StructField("BackdropUrl", T.StringType()),
        T.StructField("ReleaseDate", T.DateType()),
        T.StructField("p_CreatedDate", T.DateType()),
        T.StructField("UpdatedDate", T.StringType()),
        T.StructField("UpdatedBy", T.StringType()),
        T.StructField("CreatedBy", T.StringType()),
        T.StructField("Genres_Id", T.ArrayType(T.LongType())),
        T.StructField("Language_Id", T.IntegerType()),
    ]
)

SILVER_GENRES = T.StructType([T.StructField("Id", T.LongType()), T.StructField("name", T.StringType())])

SILVER_LANGUAGE = T.StructType(
    [T.StructField("Id", T.IntegerType()), T.StructField("OriginalLanguage", T.StringType())]
)

# Daily order totals.
ODS_ORDERS = T.StructType(
    [
        T.StructField("OrderId", T.LongType()),
        T.StructField("OrderTotal", T.LongType()),
        T.StructField("CustomerId", T.LongType()),
        T.StructField("OrderDate", T.DateType()),
    ]
)

# Stock items with the attributes of their JSON column as columns (fixed names and types).
STOCK_ITEM = T.StructType(
    [
        T.StructField("StockItemID", T.IntegerType()),
        T.StructField("StockItemName", T.StringType()),
        T.StructField("SupplierID", T.IntegerType()),
        T.StructField("ColorID", T.IntegerType()),
        T.StructField("UnitPackageID", T.IntegerType()),
        T.StructField("OuterPackageID", T.IntegerType()),
        T.StructField("Brand", T.StringType()),
        T.StructField("Size", T.StringType()),
        T.StructField("LeadTimeDays", T.IntegerType()),
        T.StructField("QuantityPerOuter", T.IntegerType()),
        T.StructField("IsChillerStock", T.IntegerType()),
        T.StructField("Barcode", T.StringType()),
        T.StructField("TaxRate", T.DecimalType(18, 3)),
        T.StructField("UnitPrice", T.DecimalType(18, 2)),
        T.StructField("RecommendedRetailPrice", T.DecimalType(18, 2)),
        T.StructField("TypicalWeightPerUnit", T.DecimalType(18, 3)),
        T.StructField("MarketingComments", T.StringType()),
        T.StructField("InternalComments", T.StringType()),
        T.StructField("CountryOfManufacture", T.StringType()),
        T.StructField("Range", T.StringType()),
        T.StructField("ShelfLife", T.StringType()),
    ]
)

# One element of a missed-purchase-orders document (fixed names): every field arrives as text.
PURCHASE_ORDER_FIELDS = [
    ("StockItemName", "StockItemName", T.StringType()),
    ("SupplierID", "Supplier", T.IntegerType()),
    ("UnitPackageID", "UnitPackageId", T.IntegerType()),
    ("OuterPackageID", "OuterPackageId", T.IntegerType()),
    ("Brand", "Brand", T.StringType()),
    ("LeadTimeDays", "LeadTimeDays", T.IntegerType()),
    ("QuantityPerOuter", "QuantityPerOuter", T.IntegerType()),
    ("TaxRate", "TaxRate", T.DecimalType(18, 3)),
    ("UnitPrice", "UnitPrice", T.DecimalType(18, 2)),
    ("RecommendedRetailPrice", "RecommendedRetailPrice", T.DecimalType(18, 2)),
    ("TypicalWeightPerUnit", "TypicalWeightPerUnit", T.DecimalType(18, 3)),
    ("CountryOfManufacture", "CountryOfManufacture", T.StringType()),
    ("Range", "Range", T.StringType()),
    ("OrderDate", "OrderDate", T.DateType()),
    ("DeliveryMethod", "DeliveryMethod", T.StringType()),
    ("ExpectedDeliveryDate", "ExpectedDeliveryDate", T.DateType()),
    ("SupplierReference", "SupplierReference", T.StringType()),
]

PURCHASE_ORDER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "PurchaseOrders",
            T.ArrayType(
                T.StructType([T.StructField(key, T.StringType()) for _, key, _ in PURCHASE_ORDER_FIELDS])
            ),
        )
    ]
)

# Control tables of the incremental load. Cutoffs are wall-clock times without a zone.
LINEAGE = T.StructType(
    [
        T.StructField("lineage_key", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("cutoff", T.TimestampNTZType()),
        T.StructField("started", T.TimestampNTZType()),
    ]
)

CUTOFFS = T.StructType(
    [T.StructField("table_name", T.StringType()), T.StructField("cutoff", T.TimestampNTZType())]
)

PEOPLE = T.StructType(
    [
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("address", T.StringType()),
    ]
)
