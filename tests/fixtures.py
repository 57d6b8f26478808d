"""Hand-written documents with the edge rows of each entity."""

CATEGORIES = [
    {"category_id": "c1", "name": "Kitchen", "subcategories": [
        {"subcategory_id": "s1", "name": "Pans", "profit_margin": 0.2},
        {"subcategory_id": "s2", "name": "Knives", "profit_margin": 0.35}]},
    {"category_id": "c2", "name": "Garden", "subcategories": [{"subcategory_id": "s3", "name": "Tools", "profit_margin": 0.1}]},
]

PRODUCTS = [
    {"product_id": "p1", "name": "Pan with a very long descriptive name", "category_id": "c1", "subcategory_id": "s1",
     "base_price": 100.0, "current_stock": None, "is_active": None, "creation_date": "2024-01-01T00:00:00Z",
     "price_history": [{"price": 90.0, "date": "2024-01-01T00:00:00Z"}, {"price": 100.0, "date": "2024-02-01T00:00:00Z"}]},
    {"product_id": "p2", "name": "Knife", "category_id": "c1", "subcategory_id": "s2", "base_price": 50.0,
     "current_stock": 5, "is_active": False, "creation_date": "2024-01-01T00:00:00Z",
     "price_history": [{"price": 50.0, "date": "2024-01-01T00:00:00Z"}]},
    {"product_id": "p3", "name": "Spade", "category_id": "c2", "subcategory_id": "s9", "base_price": 70.0,
     "current_stock": 1, "is_active": True, "creation_date": "2024-01-01T00:00:00Z", "price_history": []},
]

USERS = [
    {"user_id": "u1", "name": "Ann", "email": "a@x", "phone": "1", "geo_data": {"city": "K", "province": "North", "country": "R"},
     "registration_date": "2024-01-10T08:00:00Z", "last_active": "2024-03-01T00:00:00Z"},
    {"user_id": "u2", "name": "Bob", "email": "b@x", "phone": "2", "geo_data": None,
     "registration_date": "2024-02-10T08:00:00Z", "last_active": "2024-03-01T00:00:00Z"},
    {"user_id": "u3", "name": "Cid", "email": "c@x", "phone": "3", "geo_data": {"city": "L", "province": "South", "country": "R"},
     "registration_date": "2024-03-10T08:00:00Z", "last_active": "2024-03-11T00:00:00Z"},
]


def item(product, quantity, price):
    return {"product_id": product, "quantity": quantity, "unit_price": price, "subtotal": quantity * price}


def txn(tid, session, user, ts, items, discount=0.0, method="card", status="completed"):
    subtotal = sum(i["subtotal"] for i in items)
    return {"transaction_id": tid, "session_id": session, "user_id": user, "timestamp": ts, "items": items,
            "subtotal": subtotal, "discount": discount, "total": subtotal - discount, "payment_method": method, "status": status}


TRANSACTIONS = [
    txn("t1", "x1", "u1", "2024-01-15T10:00:00Z", [item("p1", 2, 100.0), item("p2", 1, 50.0)], 25.0, "card", "completed"),
    txn("t2", "x2", "u1", "2024-02-15T10:00:00Z", [item("p1", 1, 90.0), item("p2", 1, 55.0), item("p3", 1, 70.0)], 0.0, "cash", "shipped"),
    txn("t3", "x3", "u2", "2024-02-20T10:00:00Z", [item("p1", 1, 80.0), item("p1", 1, 80.0), item("p9", 1, 10.0)], 0.0, "cash", "refunded"),
    txn("t4", "x4", "u2", "2024-02-20T12:00:00Z", [item("p2", 3, 60.0)], 0.0, "card", "processing"),
    txn("t5", "x9", "u2", "2024-04-01T12:00:00Z", [item("p1", 0, 100.0)], 0.0, "card", "completed"),
]


def view(minute, page, product=None, seconds=10):
    return {"timestamp": f"2024-01-15T10:{minute:02d}:00Z", "page_type": page, "product_id": product, "category_id": None,
            "view_duration": seconds}


def session(sid, user, start, end, seconds, views, viewed, cart, status, device="mobile", system="iOS", referrer="direct"):
    return {"session_id": sid, "user_id": user, "start_time": start, "end_time": end, "duration_seconds": seconds,
            "geo_data": {"city": "K", "state": "North", "country": "R", "ip_address": "0"},
            "device_profile": {"type": device, "os": system, "browser": "Chrome"}, "viewed_products": viewed,
            "page_views": views, "cart_contents": cart, "conversion_status": status, "referrer": referrer}


SESSIONS = [
    session("x1", "u1", "2024-01-15T05:59:00Z", "2024-01-15T06:10:00Z", 660,
            [view(0, "home"), view(1, "product", "p1", 30), view(2, "checkout", None, 20)], ["p1"],
            {"p1": {"quantity": 2, "price": 100.0}, "p2": {"quantity": 1, "price": 50.0}}, "converted"),
    session("x2", "u1", "2024-01-15T06:00:00Z", "2024-01-15T06:01:00Z", 60, [view(0, "home")], [], {}, "browsing", "desktop", "Windows", "email"),
    session("x3", "u2", "2024-01-16T12:00:00Z", "2024-01-16T12:30:00Z", 1800, [], [], None, "browsing", "desktop", "Windows", "email"),
    session("x4", "u2", "2024-01-17T18:00:00Z", "2024-01-17T18:20:00Z", 1200, [view(0, "home"), view(1, "home")], ["p1", "p2"],
            {"p9": {"quantity": 1, "price": 10.0}}, "abandoned"),
    session("x5", "u2", "2024-01-17T21:59:00Z", "2024-01-17T22:20:00Z", 1260, [view(0, "search")], ["p1"],
            {"p1": {"quantity": 1, "price": 100.0}}, "browsing"),
    session("x6", "u2", "2024-01-17T22:00:00Z", "2024-01-17T22:20:00Z", 1200, [view(0, "search")], ["p1"], {}, "browsing"),
]
