"""Golden inputs and results of the seven jobs, as CSV text.

Fixed values: all rows below are the stored inputs and results of the golden
cases, as listed in FIXTURES.md section 1.
"""

SALES_SMALL = """date,region,product,revenue
2024-01-01,EU,A,1200
2024-01-02,US,A,900
2024-01-03,EU,B,1500
2024-01-04,EU,A,700
2024-01-05,US,B,1100
"""

SALES_EIGHT = """date,region,product,revenue
2024-01-01,EU,A,1200
2024-01-02,US,A,900
2024-01-03,EU,B,1500
2024-01-04,EU,A,700
2024-01-05,US,B,1100
2024-01-06,EU,B,800
2024-01-07,US,A,600
2024-01-08,EU,A,400
"""

SALES_PRODUCTS = """order_id,product_id,region,quantity,unit_price
1,101,EU,10,20
2,102,EU,5,15
3,103,US,8,30
4,999,US,4,25
5,101,EU,-3,20
6,102,APAC,7,-10
7,103,APAC,6,30
8,101,US,3,20
"""

PRODUCTS = """product_id,product_name,category,unit_cost
101,Widget A,Hardware,8
102,Widget B,Hardware,6
103,Service C,Services,12
"""

SALES_CATEGORY = """order_id,region,category,quantity,unit_price
1,EU,Hardware,2,100
2,EU,Software,1,200
3,US,Hardware,3,50
4,US,Software,2,150
5,APAC,Hardware,1,120
6,APAC,Software,2,130
7,EU,Hardware,0,100
8,US,Hardware,2,-10
9,EU,Services,1,180
10,US,Services,2,110
"""

ORDERS_MONTHLY = """order_id,customer_id,order_date,quantity,unit_price
O1,C1,2024-01-15,2,100
O2,C2,2024-01-20,1,200
O3,C1,2024-02-05,3,100
O4,C3,2024-02-18,2,150
O5,C5,2024-02-25,1,500
O6,C2,2024-03-02,0,100
O7,C4,2024-03-10,2,120
O8,C1,invalid_date,1,100
O9,C3,2024-03-28,1,-50
"""

CUSTOMERS_MONTHLY = """customer_id,segment
C1,Enterprise
C2,SMB
C3,Enterprise
C4,
"""

ORDER_BATCHES = {
    "orders-2024-01-10-0000.csv": "order_id,customer_id,order_date,quantity,unit_price\n"
    "1001,1,2024-01-05,2,100\n1002,2,2024-01-07,1,200\n",
    "orders-2024-02-05-0000.csv": "order_id,customer_id,order_date,quantity,unit_price\n"
    "1003,3,2024-02-01,3,200\n1004,4,2024-02-03,1,500\n",
    "orders-2024-03-01-0000.csv": "order_id,customer_id,order_date,quantity,unit_price\n"
    "1005,2,2024-03-01,2,150\n",
    "orders-2024-03-10-0000.csv": "order_id,customer_id,order_date,quantity,unit_price\n"
    "1006,1,2024-01-20,1,300\n",
    "orders-2024-03-15-0000.csv": "order_id,customer_id,order_date,quantity,unit_price\n"
    "1004,4,2024-02-03,2,500\n",
}

CUSTOMERS_INC = """customer_id,segment
1,Enterprise
2,SMB
3,Enterprise
4,
5,SMB
6,Enterprise
"""

# Expected results (FIXTURES.md section 1).
MONTHLY_REPORT_J5 = [
    ("2024-01", "Enterprise", 1, 1, 200.0, 200.0, 200.0),
    ("2024-01", "SMB", 1, 1, 200.0, 200.0, 200.0),
    ("2024-01", "ALL", 2, 2, 400.0, 400.0, 400.0),
    ("2024-02", "Enterprise", 2, 2, 600.0, 800.0, 400.0),
    ("2024-02", "UNKNOWN", 1, 1, 500.0, 500.0, 500.0),
    ("2024-02", "ALL", 3, 3, 1100.0, 1500.0, 750.0),
    ("2024-03", "UNKNOWN", 1, 1, 240.0, 740.0, 370.0),
    ("2024-03", "ALL", 1, 1, 240.0, 1740.0, 580.0),
]

INCREMENTAL_REPORT_J6 = [
    ("2024-01", "Enterprise", 2, 1, 500.0, 500.0, 500.0),
    ("2024-01", "SMB", 1, 1, 200.0, 200.0, 200.0),
    ("2024-01", "ALL", 3, 2, 700.0, 700.0, 700.0),
    ("2024-02", "Enterprise", 1, 1, 600.0, 1100.0, 550.0),
    ("2024-02", "UNKNOWN", 1, 1, 1000.0, 1000.0, 1000.0),
    ("2024-02", "ALL", 2, 2, 1600.0, 2300.0, 1150.0),
    ("2024-03", "SMB", 1, 1, 300.0, 500.0, 250.0),
    ("2024-03", "ALL", 1, 1, 300.0, 2600.0, 866.6666666666666),
]
